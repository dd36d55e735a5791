"""pairforge: preference-data processing as Spark DataFrame plans.

Sub-packages:

* ``functions``  -- Column expressions (chat rendering, array argmax/argsort,
  numerically stable log-sigmoid, whitespace tokens).
* ``operators``  -- DataFrame -> DataFrame operators (pair selection,
  candidate fan-out/merge, ordinals and shards, preference losses, token
  reductions, summaries, model hooks).
* ``sources``    -- table readers, JSONL sources/sinks, derived test inputs.
* ``plans``      -- iteration driver and the contract query catalogue.
* ``streaming``  -- the row-local operators over a JSONL landing folder.
"""

__version__ = "0.1.0"

from .functions.chat import normalise_chat, render_chat, reward_model_text  # noqa: E402
from .operators.candidates import drop_short, join_candidates, overlength_guard, to_long, to_wide  # noqa: E402
from .operators.hooks import generate_candidates, generate_wide, score_candidates, score_wide, score_with_model  # noqa: E402
from .operators.losses import batch_loss, batch_metrics, preference_loss  # noqa: E402
from .operators.ordering import (head_n, sanity_cut, shard_cover, shard_floor, shard_round_robin,  # noqa: E402
                                 shuffle, with_ordinal)
from .operators.pairs import build_eval_pairs, build_pairs, build_pairs_multi, pair_outcomes  # noqa: E402
from .operators.summaries import run_record, score_summary, shard_counts  # noqa: E402
from .operators.tokens import (batch_nll, pack_spans, pack_tokens, role_mask, sequence_logps,  # noqa: E402
                               stack_split, truncate_pair)
from .plans.iteration import IterationConfig, iteration_losses, run_iteration, run_iterations  # noqa: E402
from .sources.jsonl import (add_row_ids, read_jsonl, read_records, read_shard_files, read_shards, write_jsonl,  # noqa: E402
                            write_record, write_shard_files, write_sharded)  # noqa: E402
