"""Exact Jaccard self-join on word n-grams by universe partition and pigeonhole.

Sets are put into bands by size. A band fixes the largest symmetric difference H of a linked pair whose smaller
set is in the band, and parts the universe of n-grams (by hash) into segments. Segment i is worth v = 1 when only
its exact subset is indexed, and v = 2 when the subsets with one n-gram deleted are indexed as well. Unmatched
segments are worth H at most, so a set whose segments are worth W shares, exactly or up to one deletion, segments
worth W - H with each of its partners. How many segments are worth 2 is chosen per band by cost: rows written
against rows expected to meet by chance. More segments are cut than H + 1, so W - H is several of them.

The hashes of the subsets (keys) meet in parts of the key space. Keys with few members give pairs, counted: a pair
is verified when it shares as many of them as both sets need, less their keys with many members. A set with so
many crowded keys that it needs none is heavy. Heavy sets with a crowded key in common are one hot group, in which all
are compared, in blocks, where links are counted and only a spanning forest is given on. Every link is verified on
the whole sets and counted once on either side, with the copies of the other set.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplylens.llm.common import LOWER, as_bytes, mix, text_slices, utf8, window_hashes, word_hashes, written

U = np.uint64


@dataclass(frozen=True)
class Join:
    """Links where ``den * intersection >= num * union`` on sets of ``words``-word shingles."""

    num: int = 80
    den: int = 100
    words: int = 5
    band: float = 1.5
    spare: float = 1.5
    #: shingles whose keys are gathered in one task, on average
    part: int = 1_000_000
    #: bytes of text that a task takes at once
    slice: int = 2_000_000
    #: texts that reach a task in one Arrow batch
    batch: int = 1_000
    #: a key with more members gives no counted pairs
    crowd: int = 16
    #: sets of a hot group that are compared in one task with as many others
    block: int = 1500


def shingles(raw: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of a text in UTF-8, case of A-Z ignored; fewer words make one."""
    h = word_hashes((raw or b"").translate(LOWER))
    if not len(h):
        return h
    s = np.sort(window_hashes(h, min(n, len(h))))
    return s[np.append(True, s[1:] != s[:-1])]


def overlap_links(a: np.ndarray, b: np.ndarray, j: Join) -> bool:
    """Whether two sorted sets are linked."""
    if not len(a) or not len(b) or j.den * min(len(a), len(b)) < j.num * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    both = int((a[at] == b).sum())
    return j.den * both >= j.num * (len(a) + len(b) - both)


@lru_cache(maxsize=8)
def bands(j: Join, largest: int = 1 << 40) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First size, H, segments and how many of these are worth 2, per band."""
    lo = [1]
    while lo[-1] < largest:
        lo.append(max(lo[-1] + 1, int(np.ceil(lo[-1] * max(j.band, j.den / j.num)))))
    first = np.array(lo, dtype=np.int64)
    top = np.append(first[1:] - 1, largest * 2)
    most = (top + top * j.den // j.num) * (j.den - j.num) // (j.den + j.num)
    worth = np.where(most == 0, 1, np.ceil((most + 1) * j.spare).astype(np.int64) + 2)
    double = np.array([_doubles(int(w), int(t)) for w, t in zip(worth, top)], dtype=np.int64)
    return first, most, worth - double, double


def _doubles(worth: int, size: int) -> int:
    """The number of segments worth 2 with the least cost, when all are worth ``worth`` together.

    With k segments of s = size / k n-grams, an exact segment writes one row, a double one 1 + s. A chance meeting
    is likelier the fewer n-grams a key holds: it is priced at ``e**-s`` of a pair check, which costs as 40 rows.
    """
    best, at = None, 0
    for d in {0, worth // 4, worth // 3, worth // 2}:
        k = worth - d
        s = size / k
        cost = (k - d) * (1 + 40 * np.exp(-s)) + d * (1 + s) * (1 + 40 * np.exp(-max(s - 1, 0)))
        if best is None or cost < best:
            best, at = cost, d
    return at


def _keys_in_band(h: np.ndarray, band: int, j: Join) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Keys of one set in a band, the segment of each, the worth of each segment with n-grams, and H."""
    _, most, count, double = bands(j)
    m, d = int(count[band]), int(double[band])
    seg = (((h >> U(32)) * U(m)) >> U(32)).astype(np.int64)  # ranges of the hash: segments are runs of the sorted set
    start = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
    used, size = seg[start], np.diff(np.append(start, len(h)))
    own = mix(h ^ U(0xA5A5A5A5A5A5A5A5))
    total = np.add.reduceat(own, start)
    salt = mix(used.astype(U) * U(1 << 12) + U(band))
    keys, owner = [mix(total + salt)], [used]
    wide = np.flatnonzero((used < d) & (size > 1))
    if len(wide):
        pick = np.isin(seg, used[wide])
        back = np.searchsorted(used, seg[pick])
        keys.append(mix(total[back] - own[pick] + salt[back]))
        owner.append(seg[pick])
    worth = np.where((used < d) & (size > 1), 2, 1)
    return np.concatenate(keys), np.concatenate(owner), worth, int(most[band])


def set_bands(n: int, j: Join) -> list[int]:
    """The bands in which a set of n shingles takes part: its own, and the one below if it has partners there."""
    first = bands(j)[0]
    b = int(np.searchsorted(first, n, side="right")) - 1
    below = b > 0 and n * j.num <= (int(first[b]) - 1) * j.den
    return [b, b - 1] if below else [b]


def keys_of(h: np.ndarray, j: Join) -> np.ndarray:
    """All keys of a set. One whose segments are not worth enough also meets by its single n-grams."""
    out = []
    for b in set_bands(len(h), j):
        keys, _, worth, most = _keys_in_band(h, b, j)
        out.append(keys)
        if worth.sum() <= most:
            out.append(token_keys(h, b))
    return np.concatenate(out)


def token_keys(h: np.ndarray, band: int) -> np.ndarray:
    return mix(h + mix(np.array([(1 << 40) + band], dtype=U)))


def set_id(h: np.ndarray) -> int:
    return int(np.add.reduce(mix(h + U(len(h)))) >> U(1)) if len(h) else -1


def needed(h: np.ndarray, j: Join) -> int:
    """How many keys a set shares at least with each partner that has no other ones."""
    out = []
    for b in set_bands(len(h), j):
        _, _, worth, most = _keys_in_band(h, b, j)
        left = int(worth.sum()) - most
        out.append(max(1, -(-left // int(worth.max()))))
    return min(out)


def members(docs: DataFrame, j: Join) -> DataFrame:
    """doc_id, text_key (hash of the text), n_shingles, set_id (-1 for the empty set) and need of each document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, j.slice):
            sets = [shingles(t, j.words) for t in utf8(batch.column("text"))]
            columns = {
                "doc_id": batch.column("doc_id"),
                "text_key": batch.column("text_key"),
                "n_shingles": pa.array([len(h) for h in sets], pa.int64()),
                "set_id": pa.array([set_id(h) for h in sets], pa.int64()),
                "need": pa.array([needed(h, j) if len(h) else 0 for h in sets], pa.int32()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(scan, f"doc_id {kind}, text_key long, n_shingles long, set_id long, need int")


def _pairs_of_small(key: np.ndarray, owner: np.ndarray, start: np.ndarray, size: np.ndarray, crowd: int) -> pd.DataFrame:
    """Pairs within the keys of 2 .. crowd members, with the number of such keys of this part that they share."""
    out = []
    for z in range(2, crowd + 1):
        at = start[size == z]
        if len(at):
            rows = owner[at[:, None] + np.arange(z)]
            i, k = np.triu_indices(z, 1)
            out.append(np.stack([rows[:, i].ravel(), rows[:, k].ravel()], axis=1))
    if not out:
        return pd.DataFrame({"a": [], "b": [], "n": []}, dtype="int64")
    pairs = np.concatenate(out)
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    first = np.flatnonzero(np.append(True, (pairs[1:] != pairs[:-1]).any(axis=1)))
    return pd.DataFrame({"a": pairs[first, 0], "b": pairs[first, 1], "n": np.diff(np.append(first, len(pairs)))})


def meetings(docs: DataFrame, parts: int, j: Join) -> DataFrame:
    """Where keys meet: pairs (a, b, n), a < b, with the number n of small keys they share, in one or more rows; and
    rows (key, set_id, 0) for every member of a crowded key.

    A task writes its keys in one array per part of the key space, each set once as far as it remembers.
    """

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in text_slices(batches, j.slice):
            keys, owners = [], []
            for raw in utf8(batch.column("text")):
                h = shingles(raw, j.words)
                own = set_id(h)
                if not len(h) or own in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(own)
                keys.append(keys_of(h, j))
                owners.append(np.full(len(keys[-1]), own, dtype=np.int64))
            if not keys:
                continue
            key, owner = np.concatenate(keys), np.concatenate(owners)
            part = (key % U(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            key, owner, part = key[order], owner[order], part[order]
            start = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            stop = np.append(start[1:], len(part))
            columns = [
                pa.array(part[start]),
                pa.array([key[a:b].tobytes() for a, b in zip(start, stop)], pa.binary()),
                pa.array([owner[a:b].tobytes() for a, b in zip(start, stop)], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["part", "keys", "owners"])

    def meet(d: pd.DataFrame) -> pd.DataFrame:
        key = np.frombuffer(b"".join(d["keys"]), dtype=np.int64)
        owner = np.frombuffer(b"".join(d["owners"]), dtype=np.int64)
        order = np.lexsort((owner, key))
        key, owner = key[order], owner[order]
        new = np.append(True, (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]))
        key, owner = key[new], owner[new]
        start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(start, len(key)))
        crowded = np.repeat(size > j.crowd, size)
        return pd.concat(
            [
                _pairs_of_small(key, owner, start, size, j.crowd),
                pd.DataFrame({"a": key[crowded], "b": owner[crowded], "n": np.zeros(int(crowded.sum()), dtype=np.int64)}),
            ]
        )

    blobs = docs.select("text").where(F.col("text").isNotNull())
    blobs = blobs.mapInArrow(scatter, "part long, keys binary, owners binary")
    return blobs.groupBy("part").applyInPandas(meet, "a long, b long, n long")


def set_texts(docs: DataFrame, chosen: DataFrame, need: DataFrame) -> DataFrame:
    """set_id and one of its texts for the sets of ``need``; ``chosen`` names the hash of that text."""
    texts = docs.select(F.xxhash64("text").alias("text_key"), "text")
    return texts.join(chosen.join(need, "set_id", "left_semi"), "text_key").select("set_id", "text").dropDuplicates(["set_id"])


def verified(pairs: DataFrame, docs: DataFrame, chosen: DataFrame, j: Join) -> DataFrame:
    """Of the pairs (a, b) of set ids those that are linked."""
    need = pairs.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    own = written(set_texts(docs, chosen, need), "join-texts")
    both = pairs.join(own.select(F.col("set_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = both.join(own.select(F.col("set_id").alias("a"), F.col("text").alias("text_a")), "a")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None
        for batch in text_slices(batches, j.slice, "text_b"):
            keep = []
            for a, raw_a, raw_b in zip(batch.column("a").to_pylist(), utf8(batch.column("text_a")), utf8(batch.column("text_b"))):
                if a != last:
                    last, known = a, shingles(raw_a, j.words)
                keep.append(overlap_links(known, shingles(raw_b, j.words), j))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(check, "a long, b long")


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest place that each of ``n`` places reaches over the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def links_in_blocks(heavy: DataFrame, j: Join) -> DataFrame:
    """All links within each hot group, counted: set_id, other and n, in one or more rows of each set.

    ``heavy`` has hot (the group), set_id, copies and text. A group is cut into blocks; two blocks at a time meet in a
    task, where an inverted index counts common n-grams. ``n`` sums the copies of the sets that a set is linked with in
    the task, ``other`` is the smallest set that it reaches there.
    """
    sizes = heavy.groupBy("hot").agg(F.ceil(F.count("*") / j.block).cast("int").alias("blocks"))
    rows = heavy.join(sizes, "hot")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"i": F.least("block", "other"), "k": F.greatest("block", "other")})

    def compare(d: pd.DataFrame) -> pd.DataFrame:
        i, k = int(d["i"].iloc[0]), int(d["k"].iloc[0])
        d = d.drop_duplicates("set_id").sort_values("set_id", kind="stable").reset_index(drop=True)
        sets = [shingles(as_bytes(t), j.words) for t in d["text"]]
        size, ids, copies = np.array([len(s) for s in sets]), d["set_id"].to_numpy(), d["copies"].to_numpy()
        right, left = np.flatnonzero((d["block"] == k).to_numpy()), np.flatnonzero((d["block"] == i).to_numpy())
        n, near_a, near_b = np.zeros(len(sets), dtype=np.int64), [], []
        grams = np.concatenate([sets[r] for r in right]) if len(right) else np.zeros(0, dtype=U)
        owner = np.repeat(right, size[right])
        order = np.argsort(grams, kind="stable")
        grams, owner = grams[order], owner[order]
        for r in left:
            lo, hi = np.searchsorted(grams, sets[r], "left"), np.searchsorted(grams, sets[r], "right")
            width = hi - lo
            at = np.repeat(lo - np.cumsum(width) + width, width) + np.arange(width.sum())
            both = np.bincount(owner[at], minlength=len(sets))
            hit = np.flatnonzero((j.den * both >= j.num * (size[r] + size - both)) & (both > 0))
            hit = hit[hit != r]
            if not len(hit):
                continue
            n[r] += copies[hit].sum()
            if i != k:
                n[hit] += copies[r]
            near_a.append(np.full(len(hit), r))
            near_b.append(hit)
        if not near_a:
            return pd.DataFrame({"set_id": [], "other": [], "n": []}, dtype="int64")
        root = _roots(np.concatenate(near_a), np.concatenate(near_b), len(sets))
        at = np.flatnonzero(n)
        return pd.DataFrame({"set_id": ids[at], "other": ids[root[at]], "n": n[at]})

    return rows.groupBy("hot", "i", "k").applyInPandas(compare, "set_id long, other long, n long")


def components(edges: DataFrame) -> DataFrame:
    """node and label (smallest node reachable) of the nodes of the edges (a, b) but the labels, by rounds of star contraction."""
    at = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc"
    )
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before = at.agg(mark).first()
    while True:
        # large star: the larger neighbours of a node go to its smallest neighbour
        near = at.union(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = near.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = near.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = written(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        after = new.agg(mark).first()
        if after == before:
            return new.select(F.col("u").alias("node"), F.col("v").alias("label"))
        at, before = new, after


def labelled(sets: DataFrame, name: str, classes: DataFrame, label: str) -> DataFrame:
    """``sets`` with the class of the set id in column ``name``; a set without links is its own class."""
    c = classes.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    return sets.join(c, sets[name] == F.col("_node"), "left").withColumn(label, F.coalesce("_label", name)).drop("_node", "_label")


def linked(docs: DataFrame, j: Join = Join()) -> DataFrame:
    """Class and links of every row of ``docs`` (doc_id, text): doc_id, text_key, n_shingles, set_id, class_id,
    component_id, n_links.

    ``component_id`` is the smallest doc_id reachable by links, its own included; ``n_links`` is the number of other
    rows linked with this one, copies included. Nulls: a null text, like one without
    words, is the empty set and linked with nothing, so its component is its own id and its links are 0; a null doc_id never is the
    smallest unless the component has no other. Repeated rows have the same set and are in one component. An empty
    table gives an empty table. Other columns are not carried.
    """
    own = written(members(docs, j), "join-members", j.batch)
    total = own.agg(F.sum("n_shingles")).first()[0] or 0
    met = written(meetings(docs, max(1, -(-int(total) // j.part)), j), "join-meetings", j.batch)
    # one text per set, the one of the smallest hash
    chosen = own.where("set_id >= 0").groupBy("set_id").agg(
        F.min("text_key").alias("text_key"), F.first("need").alias("need"), F.count("*").alias("copies")
    )
    crowded = met.where("n = 0").select(F.col("a").alias("key"), F.col("b").alias("set_id"))
    load = crowded.groupBy("set_id").agg(F.count("*").alias("load"))
    sets = chosen.join(load, "set_id", "left")
    sets = written(
        sets.select("set_id", "text_key", "copies", (F.col("need") - F.coalesce("load", F.lit(0))).alias("left")), "join-sets"
    )
    chosen = sets.select("set_id", "text_key")
    # heavy sets that share crowded keys, by way of the set of each key that has most crowded keys
    heavy = crowded.join(sets.where("left <= 0").select("set_id"), "set_id", "left_semi")
    heavy = written(heavy.join(load, "set_id"), "join-heavy")
    best = heavy.groupBy("key").agg(F.min(F.struct(-F.col("load"), F.col("set_id"))).alias("m"))
    spokes = heavy.join(best, "key").select(F.col("m.set_id").alias("a"), F.col("set_id").alias("b")).where("a <> b").distinct()
    hot = components(spokes)
    hot = hot.select(F.col("node").alias("set_id"), F.col("label").alias("hot")).union(hot.select("label", "label").distinct())
    group = written(hot.join(sets.select("set_id", "copies"), "set_id"), "join-hot")
    shared = met.where("n > 0").groupBy("a", "b").agg(F.sum("n").alias("n"))
    state = sets.select("set_id", "left").join(group.select("set_id", "hot"), "set_id", "left")
    least = lambda side: state.select(
        F.col("set_id").alias(side), F.col("left").alias(f"need_{side}"), F.col("hot").alias(f"hot_{side}")
    )
    shared = shared.join(least("a"), "a").join(least("b"), "b")
    apart = F.coalesce(F.col("hot_a") != F.col("hot_b"), F.lit(True))  # pairs of one hot group meet in its blocks
    pairs = shared.where(apart & (F.col("n") >= F.greatest("need_a", "need_b", F.lit(1)))).select("a", "b")
    links = written(verified(pairs, docs, chosen, j), "join-links", j.batch)
    edges, counts = links, []
    for this, that in (("a", "b"), ("b", "a")):
        copies = sets.select(F.col("set_id").alias(that), "copies")
        counts.append(links.join(copies, that).select(F.col(this).alias("set_id"), F.col("copies").alias("n")))
    if not group.isEmpty():
        texts = set_texts(docs, chosen, group.select("set_id"))
        inside = written(links_in_blocks(group.join(texts, "set_id"), j), "join-links")
        edges = edges.union(inside.select("set_id", "other"))
        counts.append(inside.select("set_id", "n"))
    classes = components(edges)
    others = counts[0]
    for more in counts[1:]:
        others = others.union(more)
    others = others.groupBy("set_id").agg(F.sum("n").alias("_others"))
    per_set = sets.select("set_id", "copies").join(others, "set_id", "left")
    per_set = per_set.select("set_id", (F.col("copies") - 1 + F.coalesce("_others", F.lit(0))).alias("n_links"))
    out = labelled(own.join(per_set, "set_id", "left"), "set_id", classes, "class_id").withColumn(
        "class_id", F.when(F.col("set_id") >= 0, F.col("class_id"))
    )
    least_id = out.where("class_id is not null").groupBy("class_id").agg(F.min("doc_id").alias("_least"))
    out = out.join(least_id, "class_id", "left")
    return out.select(
        "doc_id", "text_key", "n_shingles", "set_id", "class_id", F.coalesce("_least", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
