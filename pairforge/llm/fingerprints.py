r"""I-Match fingerprints with randomised lexicons, in DataFrame functions only.

A text's terms are its distinct lower-cased runs of letters and digits.  The lexicon holds the terms whose share of
all documents lies in a chosen band (an inverse-document-frequency band: neither function words nor rare words), at
least ``LEAST_DF`` documents.  ``K`` randomised lexicon subsets take a term by its hash: subset k of scale s holds the
terms whose hash is k modulo ``K * 2**s``.  A text uses the scale at which a subset holds a term or two of it, and the
next sparser one: for both it sorts the lexicon terms of every subset and hashes them.  A subset's
hash survives an edit that leaves its few terms alone, so two texts are as alike as their share of equal hashes among
the subsets that either uses (``likeness``).

``edit_with_next`` builds the edited text: the last third of the code points gives way to as many from the start of
the next document in descending id order (after the last, the first).  The order is found on (id, text hash) pairs
alone, by range partitions and the first pair of each; texts are shuffled once, and the pieces that replace
text once more.

The lexicon is broadcast: a term needs ``BAND[0]`` of all documents, so it has at most (mean number of terms of a
document) / ``BAND[0]`` terms whatever the number of documents; beyond ``BROADCAST_ROWS`` it is joined by a shuffle.

The band counts copies, so what the members of a large group of (near) copies share is above it, and what a small
language holds may be below.  So a fingerprint also has the same subsets over all terms, whatever their frequency; a text is
weak if its lexicon terms reach fewer than ``LEAST_SHARE`` of the subsets that all its terms reach.  Two fingerprints are
compared by the lexicon's subsets, or by those of all terms as soon as one of them is weak; both is read off the
fingerprints, so ``near_edited`` and ``near_next`` are the ``likeness`` of the returned columns, on every row.
A fingerprint without any lexicon term starts with ``x:``.

Rows: a null text is an empty text.  A text without terms has ``x:`` and a constant as fingerprint (alike only to
equal ones).  Rows that repeat an (id, text) pair stand at one place in the order and get equal
results; rows of one id with different texts are ordered by the texts' hashes; a null id comes last.  A
table of one document is followed by itself.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, written

BAND = (0.001, 0.08)
LEAST_DF = 2
K = 32
#: A subset holds between this many and twice as many terms of a text, on average, before the band is applied.
TERMS_PER_SUBSET = 1.5
HASH_DIGITS = 6
LEAST_SHARE = 0.25
KEYS = ["ik", "th"]


def terms(text: Column) -> Column:
    return F.filter(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), lambda t: t != "")


def lexicon(docs: DataFrame, text: Column, band: tuple[float, float] = BAND, least_df: int = LEAST_DF) -> DataFrame:
    """(term, h): terms whose document frequency lies within ``band`` of all rows."""
    n = docs.count()
    df = docs.select(F.explode(terms(text)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    kept = df.where((F.col("df") >= max(least_df, band[0] * n)) & (F.col("df") <= max(band[1] * n, least_df)))
    return kept.select("term", term_hash(F.col("term")).alias("h"))


def scale_of(n_terms: Column) -> Column:
    """Scale of a text with so many terms: a subset then holds ``TERMS_PER_SUBSET`` to twice as many of them."""
    return F.greatest(F.lit(0), F.floor(F.log2(F.greatest(n_terms, F.lit(1)) / F.lit(K * TERMS_PER_SUBSET)))).cast("int")


def in_cut(h: Column, scale: Column) -> Column:
    """Whether a term of hash ``h`` lies in one of the K subsets of ``scale``; its subset is then ``h mod K``."""
    return F.pmod(h, F.call_function("shiftleft", F.lit(K).cast("long"), scale)) < K


def _hash_text(h: Column) -> Column:
    return F.substring(F.lpad(F.hex(h), 16, "0"), 1, HASH_DIGITS)


def term_hash(term: Column) -> Column:
    return F.xxhash64(F.lit("lexicon"), term)


def _mark(k: Column, cut: Column) -> Column:
    """Subset and ``HASH_DIGITS`` digits of its terms' hash in one integer; null for a subset without terms."""
    bits = 4 * HASH_DIGITS
    high = F.shiftrightunsigned(F.xxhash64(cut), 64 - bits)
    return F.when(k.isNotNull() & (F.size(cut) > 0), (F.shiftleft(k.cast("long"), bits) + high).cast("int"))


def _mark_texts(marks: Column) -> Column:
    bits = 4 * HASH_DIGITS
    return F.array_join(F.sort_array(F.transform(marks, lambda m: F.concat_ws(".", F.shiftright(m, bits), F.lpad(
        F.hex(m.bitwiseAND(F.lit((1 << bits) - 1))), HASH_DIGITS, "0")))), ",")


#: What a fingerprint is made of: the hashes of a text's subsets, of lexicon terms and of all terms, at two scales.
PARTS = ("cut0", "cut1", "own0", "own1")


def spelled(parts: Column) -> Column:
    """The fingerprint of a struct of ``scale``, ``PARTS`` and ``whole``, the hash of all terms."""
    kind = F.when(F.size(parts["cut0"]) == 0, F.lit("x:")).otherwise(F.lit(""))
    full = F.concat(kind, F.concat_ws(":", parts["scale"], *[_mark_texts(parts[c]) for c in PARTS]))
    return F.when(F.size(parts["own0"]) == 0, F.concat(F.lit("x:"), F.hex(parts["whole"]))).otherwise(full)


def _likeness(a: tuple[Column, ...], b: tuple[Column, ...], subset: Callable[[Column], Column]) -> Column:
    """Share of equal subset hashes of two (scale, hashes at it, hashes at the next), at the scales that both have."""
    (sa, a0, a1), (sb, b0, b1) = a, b

    def alike(x: Column, y: Column) -> Column:
        subsets = lambda z: F.transform(z, subset)
        used = F.size(F.array_union(subsets(x), subsets(y)))
        return F.when(used == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / used)

    return F.when(sa == sb, F.greatest(alike(a0, b0), alike(a1, b1))) \
        .when(sa == sb - 1, alike(a1, b0)).when(sa == sb + 1, alike(a0, b1)).otherwise(F.lit(0.0))


def _compared(a: dict[str, Column], b: dict[str, Column], subset: Callable[[Column], Column]) -> Column:
    """By lexicon subsets, or by those of all terms as soon as one side is weak."""
    weak = lambda x: F.size(x["cut0"]) < F.size(x["own0"]) * LEAST_SHARE
    by = lambda kind: _likeness(*[(x["scale"], x[kind + "0"], x[kind + "1"]) for x in (a, b)], subset)
    return F.when(weak(a) | weak(b), by("own")).otherwise(by("cut"))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the share of equal subset hashes at the scales that both fingerprints have; 1 for equal fingerprints."""
    def parts(x: Column) -> dict[str, Column]:
        p = F.split(F.regexp_replace(x, "^x:", ""), ":")
        cut = lambda i: F.array_remove(F.split(F.get(p, F.lit(i)), ","), "")
        return {"scale": F.when(F.size(p) == 5, F.get(p, F.lit(0)).try_cast("int"))} | {c: cut(i + 1) for i, c in enumerate(PARTS)}

    other = _compared(parts(a), parts(b), lambda t: F.substring_index(t, ".", 1))
    return F.when(a == b, F.lit(1.0)).otherwise(F.coalesce(other, F.lit(0.0)))


def parts_likeness(a: Column, b: Column) -> Column:
    """``likeness`` of two structs of parts."""
    empty = lambda x: F.size(x["own0"]) == 0
    alike = reduce(lambda x, y: x & y, [a[c] == b[c] for c in ("scale", *PARTS)])
    same = F.when(empty(a) & empty(b), a["whole"] == b["whole"]).otherwise(alike)
    other = _compared(a, b, lambda m: F.shiftright(m, 4 * HASH_DIGITS))
    return F.when(same, F.lit(1.0)).when(empty(a) | empty(b), F.lit(0.0)).otherwise(other)


def succession(keys: DataFrame) -> DataFrame:
    """Distinct (id, ik, th) rows in descending id order -> + (next_ik, next_th), the last followed by the first.

    Ranges of ids are ordered on their own; the first row of every range, one row each, links them."""
    order = [F.desc_nulls_last("id"), F.asc("th")]
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(keys.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()))
    within = Window.partitionBy("range").orderBy(*order)
    after = F.lead(F.struct("ik", "th")).over(within)
    linked = ranged.withColumns({"after": after, "at": F.row_number().over(within)})
    heads = linked.where("at = 1").select("range", F.struct("ik", "th").alias("head"))
    ranges = Window.orderBy("range")
    onward = heads.select("range", F.coalesce(F.lead("head").over(ranges), F.first("head").over(
        ranges.rowsBetween(Window.unboundedPreceding, Window.currentRow))).alias("onward"))
    following = F.coalesce("after", "onward")
    return linked.join(onward, "range").select(*keys.columns, following["ik"].alias("next_ik"), following["th"].alias("next_th"))


def edit_with_next(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` (id, text) -> (ik, th, prev_ik, prev_th, text, edited) with one row per distinct pair, and the order of the
    pairs: id, ik, th, n_chars, next_ik, next_th and ``copies``, the number of rows with that pair.  (ik, th) is the pair's
    key: the id as text, never null, and the text's hash."""
    ik = F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit(""))
    texts = docs.select("id", ik.alias("ik"), F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    keys = texts.groupBy(*KEYS).agg(F.min("id").alias("id"), F.max(F.char_length("text")).cast("long").alias("n_chars"),
                                    F.count(F.lit(1)).alias("copies"))
    chain = written(succession(keys))
    lead = chain.select(F.col("next_ik").alias("ik"), F.col("next_th").alias("th"), F.col("ik").alias("prev_ik"),
                        F.col("th").alias("prev_th"), F.floor(F.col("n_chars") / 3).cast("int").alias("room"))
    first = F.row_number().over(Window.partitionBy(*KEYS).orderBy(*KEYS))
    placed = texts.select(*KEYS, "text").withColumn("_row", first).where("_row = 1").drop("_row") \
        .join(chain.join(lead, KEYS), KEYS)
    pieces = placed.select(F.col("prev_ik").alias("ik"), F.col("prev_th").alias("th"), F.substr("text", F.lit(1), F.col("room")).alias("piece"))
    kept = F.expr("left(text, cast(n_chars - floor(n_chars / 3) as int))")
    return placed.join(pieces, KEYS).select(*KEYS, "prev_ik", "prev_th", "text", F.concat(kept, F.col("piece")).alias("edited")), chain


def both_fingerprints(edited: DataFrame, lex: DataFrame) -> DataFrame:
    """(ik, th, prev_ik, prev_th, text, edited) -> (ik, th, prev_ik, prev_th, sha, own, edited_own): the edited text's
    SHA-256 and the parts of both fingerprints.

    Only terms of a text's own subsets are looked up in the lexicon, some ``2 * K * TERMS_PER_SUBSET`` of a text however
    long it is.  All groupings are by the key that the rows are partitioned by already."""
    bodies = edited.select(*KEYS, "prev_ik", "prev_th", F.inline(F.array(
        F.struct(F.lit(0).alias("of"), F.col("text").alias("body")), F.struct(F.lit(1).alias("of"), F.col("edited").alias("body")))))
    counted = bodies.withColumn("terms", terms(F.col("body"))).select(
        *KEYS, "of", "terms", scale_of(F.size("terms")).alias("scale"), F.struct(
            F.xxhash64(F.sort_array("terms")).alias("whole"), F.when(F.col("of") == 1, F.unhex(F.sha2(F.col("body").cast("binary"), 256))).alias("sha"),
            "prev_ik", "prev_th").alias("about"))
    own = F.filter("terms", lambda t: in_cut(term_hash(t), F.col("scale")))
    # the empty term keeps every text, and carries what belongs to the whole text
    cells = F.concat(F.array(F.struct(F.lit("").alias("term"), F.col("about"))),
                     F.transform(own, lambda t: F.struct(t.alias("term"), F.lit(None).cast(counted.schema["about"].dataType).alias("about"))))
    rows = counted.select(*KEYS, "of", "scale", F.explode(cells).alias("t")).select(*KEYS, "of", "scale", "t.*")
    known = rows.join(lex, "term", "left").withColumn("g", F.when(F.col("term") != "", term_hash(F.col("term"))))
    next_cut = lambda h: F.when(in_cut(F.col(h), F.col("scale") + 1), F.col(h))
    subsets = known.groupBy(*KEYS, "of", "scale", F.pmod("g", F.lit(K)).alias("k")).agg(
        F.sort_array(F.collect_list("h")).alias("cut0"), F.sort_array(F.collect_list(next_cut("h"))).alias("cut1"),
        F.sort_array(F.collect_list("g")).alias("own0"), F.sort_array(F.collect_list(next_cut("g"))).alias("own1"),
        F.max("about").alias("about"))
    marks = subsets.select(*KEYS, "of", "scale", "about", *[_mark(F.col("k"), F.col(c)).alias(c) for c in PARTS])
    texts = marks.groupBy(*KEYS, "of", "scale").agg(*[F.sort_array(F.collect_list(c)).alias(c) for c in PARTS], F.max("about").alias("about"))
    parts = F.struct("scale", *PARTS, F.col("about.whole").alias("whole"))
    of = lambda i, c: F.max(F.when(F.col("of") == i, c))
    return texts.groupBy(*KEYS).agg(
        F.max("about.prev_ik").alias("prev_ik"), F.max("about.prev_th").alias("prev_th"), F.max("about.sha").alias("sha"),
        of(0, parts).alias("own"), of(1, parts).alias("edited_own"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", band: tuple[float, float] = BAND) -> DataFrame:
    """``key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` for every row."""
    docs = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    lex = written(lexicon(docs, F.col("text"), band))
    n_lex = lex.count()
    lex = F.broadcast(lex) if n_lex <= BROADCAST_ROWS else lex.hint("shuffle_merge")
    edited, chain = edit_with_next(docs)
    # every text's parts go to its own row and to the row before it, in one exchange
    both = both_fingerprints(edited, lex)
    none = lambda c: F.lit(None).cast(both.schema[c].dataType).alias(c)
    payload = ("sha", "own", "edited_own")
    sent = both.select(F.inline(F.array(
        F.struct(*KEYS, *payload, none("own").alias("next_own")),
        F.struct(F.col("prev_ik").alias("ik"), F.col("prev_th").alias("th"), *[none(c) for c in payload], F.col("own").alias("next_own")))))
    made = sent.groupBy(*KEYS).agg(*[F.max(c).alias(c) for c in (*payload, "next_own")])
    out = made.join(chain.select("id", *KEYS, "n_chars", "copies"), KEYS)
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    own, edited_own, next_own = F.col("own"), F.col("edited_own"), F.col("next_own")
    return out.select(F.col("id").alias(key), "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), spelled(own).alias("fingerprint"),
                      spelled(edited_own).alias("edited_fingerprint"), parts_likeness(own, edited_own).alias("near_edited"),
                      parts_likeness(own, next_own).alias("near_next"))
