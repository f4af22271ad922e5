"""Document fingerprints by consistent weighted sampling, in built-in functions only.

The terms of a text are its five-word shingles, a term that occurs tf times weighs ``1 + floor(log2 tf)``. Each
weighted term draws, from its own hash, r and c from Gamma(2, 1) and b from U(0, 1); with
``t = floor(ln w / r + b)`` its sample is ``ln a = ln c - r (t - b) - r`` (the logarithm of
``c / (y e^r)``, ``y = exp(r (t - b))``), and the term with the smallest sample represents the text. Two texts
choose the same (term, t) with the probability of their generalised Jaccard similarity. Terms are dealt to
``bins`` by hash and every bin keeps its own smallest sample, so that one pass over the terms yields all
samples of a signature; bins empty in both texts say nothing and do not count.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



@dataclass(frozen=True)
class Sketch:
    bin_bits: int = 7
    shingle: int = 5
    #: documents per range of ids that are sorted together, on average
    block: int = 4096
    most_blocks: int = 8192


#: Larger than any sample: stands where a repeat of a term has none.
NONE = (1 << 63) - 1
#: The white space between words.
BLANK = " \t\n\x0b\x0c\r"


def _uniform(bits: Column, shift: int) -> Column:
    """16 bits of a hash as a number between 0 and 1, both excluded."""
    return (F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit(0xFFFF)) + 0.5) / 65536.0


def weight_of_run(h: Column, x: Column, i: Column, level: int = 1) -> Column:
    """``1 + floor(log2 tf)`` at the last place ``i`` of the run of ``x`` in the sorted array ``h``."""
    if level > 30:
        return F.lit(level)
    back = (1 << level) - 1
    return F.when((i >= back) & (F.get(h, i - back) == x), weight_of_run(h, x, i, level + 1)).otherwise(F.lit(level))


def sample(h: Column, x: Column, i: Column, s: Sketch) -> Column:
    """The sample of term ``x`` at place ``i`` of the sorted terms as one number: its bin, ln a, a name of (term, t).

    Only the last of equal terms has one. For weight 1, which most terms have, t is 0.
    """
    other = F.xxhash64(x, F.lit(1))
    r = -F.log(_uniform(x, 0) * _uniform(x, 16))
    log_c = F.log(-F.log(_uniform(x, 32) * _uniform(other, 0)))
    b = _uniform(other, 16)

    def packed(log_a: Column, name: Column) -> Column:
        # ln a lies between about -45 and 5, whatever the weight
        scaled = F.least(F.greatest((log_a + 60.0) * float(1 << 25), F.lit(0.0)), F.lit(float((1 << 32) - 1)))
        bin_ = F.shiftleft(x.bitwiseAND(F.lit((1 << s.bin_bits) - 1)), 55)
        return bin_.bitwiseOR(F.shiftleft(scaled.cast("bigint"), 23)).bitwiseOR(name.bitwiseAND(F.lit((1 << 23) - 1)))

    t = F.floor(F.log(weight_of_run(h, x, i).cast("double")) / r + b)
    return (
        F.when(F.get(h, i + 1) == x, F.lit(NONE))
        .when((i > 0) & (F.get(h, i - 1) == x), packed(log_c - r * (t - b) - r, F.xxhash64(x, t)))
        .otherwise(packed(log_c + r * (b - 1), F.shiftrightunsigned(other, 40)))
    )


def with_signature(df: DataFrame, text: str, name: str, s: Sketch = Sketch()) -> DataFrame:
    """``df`` with the signature of the column ``text``: the smallest sample of each bin that has terms, by bin.

    Step by step in columns of their own, so that both sorts are compiled and work on plain numbers.
    """
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(BLANK))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    h, t, v = F.col("_h"), F.col("_t"), F.col("_v")
    n = F.size(h)
    long = F.transform(
        F.sequence(F.lit(0), n - s.shingle), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(s.shingle)])
    )
    short = F.array(F.xxhash64(F.array_join(h.cast("array<string>"), " ")))
    terms = F.when(n >= s.shingle, long).when(n > 0, short).otherwise(F.array().cast("array<bigint>"))
    own = F.filter(
        v,
        lambda x, i: (x != NONE) & ((i == 0) | (F.shiftright(F.get(v, i - 1), 55) != F.shiftright(x, 55))),
    )
    return (
        df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
        .withColumn("_t", F.sort_array(terms))
        .withColumn("_v", F.sort_array(F.transform(t, lambda x, i: F.coalesce(sample(t, x, i, s), F.lit(NONE)))))
        .withColumn(name, own)
        .drop("_h", "_t", "_v")
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of the bins with terms in either text whose samples agree; 1 for two texts without terms."""
    same = F.size(F.array_intersect(a, b))
    high = lambda v: F.transform(v, lambda x: F.shiftright(x, 55))
    bins = F.size(F.array_union(high(a), high(b)))
    return F.when(bins == 0, F.lit(1.0)).otherwise(same / bins)


def as_text(v: Column) -> Column:
    return F.array_join(F.transform(v, lambda x: F.lower(F.hex(x))), ".")


def _blocks(docs: DataFrame, s: Sketch) -> list[int]:
    """Ids that part the documents into ranges of about ``block``: at most ``most_blocks`` numbers."""
    n = docs.count()
    parts = max(2, min(s.most_blocks, n // s.block))
    shares = F.array(*[F.lit(k / parts) for k in range(1, parts)])
    got = docs.agg(F.percentile_approx("doc_id", shares, F.lit(max(10_000, 20 * parts)))).first()[0]
    return sorted(set(got or []))


def _block_of(bounds: list[int]) -> Column:
    """How many bounds are not above the id, by binary search."""
    if not bounds:
        return F.lit(0)
    all_ = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    walk = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(bounds)) & (F.get(all_, at + step - 1) <= F.col("doc_id")), at + step
        ).otherwise(at),
    )
    return F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(walk)


def with_next(docs: DataFrame, s: Sketch = Sketch()) -> DataFrame:
    """doc_id, text, own (its signature) and the text and signature of the document that follows by (doc_id, text).

    The first follows the last. Ids are parted into ranges; inside a range one sort finds the neighbour, and the last
    document of a range takes the first one of the next range that has any. Null ids come first.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bounds = _blocks(base.select("doc_id"), s)
    base = base.withColumn("_b", _block_of(bounds))
    firsts = base.groupBy("_b").agg(F.min(F.struct("doc_id", "text")).alias("f")).select("_b", "f.text")
    over = Window.partitionBy().orderBy("_b")  # one row per range, a bounded number
    ring = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("_b", F.coalesce(F.lead("text").over(over), F.first("text").over(ring)).alias("_after"))
    after = with_signature(after, "_after", "_after_own", s)
    order = Window.partitionBy("_b").orderBy("doc_id", "text")
    near = with_signature(base.withColumn("_near", F.lead("text").over(order)), "text", "own", s)
    near = near.withColumn("_near_own", F.lead("own").over(order))
    return near.join(after, "_b").select(
        "doc_id",
        "text",
        "own",
        F.coalesce("_near", "_after").alias("next_text"),
        F.when(F.col("_near").isNull(), F.col("_after_own")).otherwise(F.col("_near_own")).alias("next_own"),
    )


def edited(text: Column, other: Column) -> Column:
    """``text`` whose last quarter of code points (rounded down) is replaced by as many from the start of ``other``."""
    n = F.char_length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - quarter), F.substr(other, F.lit(1), quarter))


def fingerprinted(docs: DataFrame, s: Sketch = Sketch()) -> DataFrame:
    """Fingerprints of every text and of its edited text, with the likeness to the edited and to the next document.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    Nulls: a null text counts as empty, an empty text has the empty fingerprint; a null doc_id comes before all
    others. Equal texts have equal fingerprints. Repeated rows stay repeated and are each other's next documents.
    A single document is its own next one. An empty table gives an empty table. Other columns are not carried.
    """
    both = with_next(docs, s).withColumn("_edited", edited(F.col("text"), F.col("next_text")))
    sketched = with_signature(both, "_edited", "_changed", s).select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("own").alias("_own"),
        "_changed",
        F.col("next_own").alias("_next"),
    )
    return sketched.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("_own")).alias("fingerprint"),
        as_text(F.col("_changed")).alias("edited_fingerprint"),
        F.round(likeness(F.col("_own"), F.col("_changed")), 6).alias("near_edited"),
        F.round(likeness(F.col("_own"), F.col("_next")), 6).alias("near_next"),
    )
