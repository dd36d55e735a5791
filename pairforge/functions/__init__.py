"""Column expressions: every function here returns a ``pyspark.sql.Column``."""

from .arrays import (argmax_first, argmin_first, argsort_last_two, array_sum, first_score,
                     has_missing, is_missing)
from .chat import (DEFAULT_BOS, END_OF_TURN, GENERATION_HEADER, append_turn, normalise_chat,
                   render_chat, reward_model_text)
from .stats import cap_exp, log_sigmoid, log_softmax_at, relu, sigmoid, softplus
from .text import (PY_WHITESPACE, TOKEN_SEPARATOR, piece_id, py_strip, strip_echo,
                   strip_echo_all, token_ids, whitespace_pieces)

__all__ = [n for n in dir() if not n.startswith("_")]
