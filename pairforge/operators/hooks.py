"""Model hooks: a user's generator, scorer or tokeniser, run by Spark per Arrow batch (G1, G3; P14, T8, T9).

The models themselves are not part of this library.  A generator is
``fn(prompts: list[str], k: int, **params) -> list[list[str]]`` (one list of
returned texts per prompt, possibly empty for over-length prompts); a scorer is
either a Column function (stays in the JVM) or a vectorised
``fn(pd.Series) -> pd.Series`` run as a pandas UDF.  A tokeniser is
``fn(texts: list[str]) -> list[list[int]]``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

Generator = Callable[..., list]
LONG_SCHEMA = "row_id long, k int, response string, prompt_chars int"

# Models loaded by ``setup`` callables, kept per Python worker: Spark reuses a
# worker across tasks (``spark.python.worker.reuse``), so a model loads once per
# worker, not once per task or batch.  The key is a digest of the pickled loader
# with its closure, so loaders made by one factory are told apart; a worker keeps
# at most ``KEPT_MODELS`` models.
KEPT_MODELS = 2
#: What a tokeniser gets at once.
TOKENISED_ROWS = 256
TOKENISED_BYTES = 1 << 20
_WORKER_MODELS: dict[str, object] = {}


def _loader(setup: Callable[[], object] | None) -> tuple[str, Callable[[], object]] | None:
    """(digest, loader), made on the driver."""
    return None if setup is None else (hashlib.sha256(cloudpickle.dumps(setup)).hexdigest(), setup)


def _model(loader: tuple[str, Callable[[], object]] | None) -> dict[str, object]:
    """Extra arguments of a hook: ``model=`` when it has a loader."""
    if loader is None:
        return {}
    name, setup = loader
    if name not in _WORKER_MODELS:
        while len(_WORKER_MODELS) >= KEPT_MODELS:
            _WORKER_MODELS.pop(next(iter(_WORKER_MODELS)))
        _WORKER_MODELS[name] = setup()
    return {"model": _WORKER_MODELS[name]}


def _returned(generate: Generator, prompts: list[str], k: int, limit: int | None, measure: Callable[[str], int], **extra) -> list[list[str]]:
    """One list of texts per prompt.  A prompt longer than ``limit`` (G2) isn't handed to the generator and gets none;
    a generator that returns another number of lists than it got prompts is an error."""
    fits = [limit is None or measure(p) <= limit for p in prompts]
    asked = [p for p, ok in zip(prompts, fits) if ok]
    outs = list(generate(asked, k, **extra)) if asked else []
    if len(outs) != len(asked):
        raise ValueError(f"the generator got {len(asked)} prompts and returned {len(outs)} lists")
    got = iter(outs)
    return [list(next(got) or []) if ok else [] for ok in fits]


def generate_candidates(df: DataFrame, generate: Generator, k: int, text: str = "prompt_text",
                        key: str = "row_id", partitions: int | None = None,
                        setup: Callable[[], object] | None = None, limit: int | None = None,
                        measure: Callable[[str], int] = len, **params) -> DataFrame:
    """G1: ``mapInPandas`` over (row_id, prompt text) -> long
    ``(row_id, k, response, prompt_chars)``; ``prompt_chars`` lets P6 strip an echo.

    Sampling settings (temperature, max_tokens, seed, top_p, top_k, stop ids, ...)
    pass through ``params``.  ``limit`` is G2's: prompts longer than that, by ``measure``
    (characters, or e.g. a tokeniser's count), get no text.  ``partitions`` spreads a heavy hook evenly
    (round-robin ``repartition``) before the model runs.
    """
    src = df.select(key, text)
    if partitions:
        src = src.repartition(partitions)

    loader = _loader(setup)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        extra = _model(loader)
        for pdf in batches:
            outs = _returned(generate, pdf[text].tolist(), k, limit, measure, **extra, **params)
            ids, ks, texts, lens = [], [], [], []
            for rid, prompt, returned in zip(pdf[key].tolist(), pdf[text].tolist(), outs, strict=True):
                for i, t in enumerate(returned):
                    ids.append(rid)
                    ks.append(i)
                    texts.append(t)
                    lens.append(len(prompt))
            yield pd.DataFrame({"row_id": pd.Series(ids, dtype="int64"),
                                "k": pd.Series(ks, dtype="int32"),
                                "response": pd.Series(texts, dtype="object"),
                                "prompt_chars": pd.Series(lens, dtype="int32")})

    return src.mapInPandas(run, LONG_SCHEMA)


def score_candidates(df: DataFrame, scorer: Callable, text: Column | str, out: str = "reward",
                     kind: str = "pandas") -> DataFrame:
    """Add ``reward`` = scorer(text).

    ``kind="column"``: ``scorer`` maps a Column to a Column and stays in the JVM.
    ``kind="pandas"``: ``scorer`` maps a ``pd.Series`` of texts to rewards and runs
    as a pandas UDF, one Arrow batch per call
    (``spark.sql.execution.arrow.maxRecordsPerBatch`` sets the batch size).
    """
    t = F.col(text) if isinstance(text, str) else text
    if kind == "column":
        return df.withColumn(out, scorer(t).cast("double"))
    if kind != "pandas":
        raise ValueError(f"unknown scorer kind {kind!r}")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(scorer(texts), dtype="float64")

    return df.withColumn(out, pandas_udf(run, "double")(t))


def generate_wide(df: DataFrame, generate: Generator, k: int, text: str = "prompt_text",
                  out: str = "responses", partitions: int | None = None,
                  setup: Callable[[], object] | None = None, limit: int | None = None,
                  measure: Callable[[str], int] = len, **params) -> DataFrame:
    """G1, wide and shuffle-free: ``mapInArrow`` appends ``responses array<string>``
    to every input row (all input columns ride along, so prompts and responses
    stay in one row and no join is needed to put them back together).

    ``setup`` (optional) loads the model once per Python worker; its result is
    passed to ``generate`` as ``model=`` for every batch.  ``limit`` and ``measure``
    are those of ``generate_candidates``.
    """
    import pyarrow as pa
    from pyspark.sql import types as T

    src = df.repartition(partitions) if partitions else df
    schema = T.StructType([*src.schema.fields, T.StructField(out, T.ArrayType(T.StringType()))])

    loader = _loader(setup)

    def run(batches):
        extra = _model(loader)
        for batch in batches:
            prompts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            outs = _returned(generate, prompts, k, limit, measure, **extra, **params)
            yield batch.append_column(out, pa.array(outs, type=pa.list_(pa.string())))

    return src.mapInArrow(run, schema)


def score_wide(df: DataFrame, scorer: Callable, texts: Column, out: str = "rewards",
               setup: Callable[[], object] | None = None) -> DataFrame:
    """G3, wide and shuffle-free: ``texts`` is one array of scorer inputs per row;
    each Arrow batch is flattened into one Series for a single vectorised scorer
    call and split back into per-row ``rewards`` arrays (parallel to the texts).
    ``setup`` (optional) loads a model once per Python worker, passed as ``model=``."""
    import numpy as np

    loader = _loader(setup)

    @pandas_udf("array<double>")
    def score(col: pd.Series) -> pd.Series:
        extra = _model(loader)
        lengths = col.map(lambda a: 0 if a is None else len(a)).to_numpy()
        flat = pd.Series([t for a in col if a is not None for t in a], dtype="object")
        vals = np.asarray(scorer(flat, **extra), dtype="float64") if len(flat) else np.zeros(0)
        bounds = np.cumsum(lengths)[:-1]
        parts = np.split(vals, bounds) if len(lengths) else []
        return pd.Series([None if a is None else list(p) for a, p in zip(col, parts)])

    return df.withColumn(out, score(texts))


def _text_parts(batch, text: str) -> Iterator:
    """The batch in parts of at most ``TOKENISED_ROWS`` rows and, of more rows than one, ``TOKENISED_BYTES`` of text."""
    import pyarrow.compute as pc

    start = held = 0
    for i, n in enumerate(pc.binary_length(batch.column(batch.schema.get_field_index(text))).to_pylist()):
        if i > start and (i - start == TOKENISED_ROWS or held + (n or 0) > TOKENISED_BYTES):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if batch.num_rows > start:
        yield batch.slice(start)


def tokenise(df: DataFrame, tokeniser: Callable[..., list], text: str = "text", out: str = "tokens",
             setup: Callable[[], object] | None = None) -> DataFrame:
    """Appends ``out array<long>``, the token ids of ``text``, to every row: P14, T8 and T9 take this column.

    ``tokeniser`` gets up to ``TOKENISED_ROWS`` texts at once, about ``TOKENISED_BYTES`` of them (a longer text alone),
    and must return a list of ids for each; a null text isn't handed over and has null ids.  So a worker holds the ids
    of that many texts, whatever the table's size.  The session's Arrow batches are lowered to as many rows (never
    raised).  ``setup`` loads a vocabulary once per Python worker (``model=``).
    """
    import pyarrow as pa
    from pyspark.sql import types as T

    spark, batch_rows = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(batch_rows)) <= TOKENISED_ROWS:
        spark.conf.set(batch_rows, str(TOKENISED_ROWS))
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.LongType()))])
    loader = _loader(setup)

    def run(batches):
        extra = _model(loader)
        for batch in batches:
            for part in _text_parts(batch, text):
                yield part.append_column(out, encoded(part.column(part.schema.get_field_index(text)).to_pylist(), extra))

    def encoded(texts, extra):
        asked = [t for t in texts if t is not None]
        ids = list(tokeniser(asked, **extra)) if asked else []
        if len(ids) != len(asked):
            raise ValueError(f"the tokeniser got {len(asked)} texts and returned {len(ids)} lists")
        got = iter(ids)
        return pa.array([None if t is None else next(got) for t in texts], type=pa.list_(pa.int64()))

    return df.mapInArrow(run, schema)


def score_with_model(df: DataFrame, make_predict_fn: Callable, text: Column | str, out: str = "reward",
                     batch_size: int = 256) -> DataFrame:
    """G3 through ``predict_batch_udf``: ``make_predict_fn()`` loads the model once
    per Python worker (and is cached there); the returned function maps a numpy
    array of texts (``batch_size`` at a time) to a numpy array of rewards."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import DoubleType

    udf = predict_batch_udf(make_predict_fn, return_type=DoubleType(), batch_size=batch_size)
    return df.withColumn(out, udf(F.col(text) if isinstance(text, str) else text))
