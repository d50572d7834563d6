"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its shingles of five words (a shorter text is one shingle):
weight = times in the document x idf. The idf of a shingle is 1 + log(1 / share of documents that
hold it), where shares under ``common_share`` count as ``common_share``: rare shingles all
weigh the same, a shingle of a third of the documents weighs 0.37 of that, one of all documents
0.18, and only shingles above that share have to be known. There are at most
(mean shingles of a document) / common_share of those at any size of the corpus, so they can be
broadcast; they are found exactly, from counts of hashed buckets over all documents first and
then from counts of the shingles that fall into buckets with enough documents.

Texts with the same words are one class from the start, represented by one text. Each
representative draws ``bands x rows`` weighted samples; those that agree in a band meet in a
group. Links are pairs that meet and have weighted Jaccard similarity of at least ``threshold``,
computed from the whole texts. First every member is compared with its group's leader, which
settles the groups whose members are one component. In all other groups every pair of members of
different components is compared: members go to cells of bounded size, and each pair of cells is
one sparse product of its members' shingles. Two cells are skipped only where no pair can be a
new link: if both hold one and the same component, or if their members' total weights are too far
apart for the threshold. The pairs of a large group of texts that are unlike in all but a passage
grow with the square of the group; they are never rows, but they are work.
Connected representatives are one class, named by the smallest document id in it.

Defined cases: a text without words (null, empty, punctuation) is a class of its own; repeated
rows are copies of each other; a null id is named by null only if it is alone in its class;
empty tables give empty results; columns other than id and text are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.components import components
from pagewright.llm.frames import id_type, map_texts, raw_bytes, written
from pagewright.llm.words import Words, mixed
from pagewright.operators.skew import heavy_keys, lookup_join

SHINGLE = 5
BUCKETS = 1 << 18
#: Most members and bytes of text that a cell of a group should hold.
CELL_ROWS, CELL_BYTES = 2000, 8 << 20
_U64 = np.uint64


@dataclass(frozen=True)
class Settings:
    """Production parameters."""

    threshold: float = 0.8
    bands: int = 12
    rows: int = 3
    common_share: float = 0.01


@dataclass
class Idf:
    """Weights of common shingles; all others have the greatest weight."""

    rare: float
    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, _U64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def of(self, shingles: np.ndarray) -> np.ndarray:
        weights = np.full(len(shingles), self.rare)
        if len(self.hashes) and len(shingles):
            at = np.minimum(np.searchsorted(self.hashes, shingles), len(self.hashes) - 1)
            known = self.hashes[at] == shingles
            weights[known] = self.weights[at[known]]
        return weights


def shingles_of(raw: bytes, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, str | None]:
    """Sorted distinct shingle hashes, their counts, and a digest of all words (None without words)."""
    words = Words(raw)
    if not len(words):
        return np.zeros(0, _U64), np.zeros(0, np.int64), None
    runs = words.runs(min(size, len(words)))
    found, counts = np.unique(runs, return_counts=True)
    return found, counts, xxhash.xxh3_128_hexdigest(words.data.tobytes().rstrip(b" "))


def weighted_samples(shingles: np.ndarray, weights: np.ndarray, starts: np.ndarray, samples: int) -> np.ndarray:
    """Names of the consistent samples of several sets that lie one after the other from ``starts``.

    A sample is the element with the least ln a, with its step: for sample j and element k,
    r, c ~ Gamma(2, 1) and b ~ U(0, 1) come from a hash of both; t = floor(ln w / r + b),
    ln a = ln c - r (t - b) - r.
    """
    logs = np.log(weights).astype(np.float32)
    sizes = np.diff(np.append(starts, len(shingles)))
    names = np.zeros((len(starts), samples), _U64)
    unit, low = np.float32(2.0**-24), _U64(0xFFFFFF)
    for j in range(samples):
        one = mixed(shingles ^ _U64((0x9E3779B97F4A7C15 * (2 * j + 1)) & 0xFFFFFFFFFFFFFFFF))
        two = mixed(one + _U64(0xD1B54A32D192ED03))
        u = [((x >> _U64(shift)) & low).astype(np.float32) * unit + unit / 2 for x in (one, two) for shift in (0, 24)]
        b = (((one >> _U64(48)) ^ (two >> _U64(40))) & low).astype(np.float32) * unit
        r = -np.log(u[0] * u[1])
        t = np.floor(logs / r + b)
        a = np.log(-np.log(u[2] * u[3])) - r * (t - b) - r
        least = np.repeat(np.minimum.reduceat(a, starts), sizes)
        hits = np.flatnonzero(a == least)
        best = hits[np.searchsorted(hits, starts)]
        names[:, j] = shingles[best] ^ mixed(t[best].astype(np.int64).view(_U64))
    return names


def band_keys(names: np.ndarray, rows: int) -> np.ndarray:
    """One key for each band of each set."""
    keys = np.zeros((len(names), names.shape[1] // rows), _U64)
    for k in range(rows):
        keys = mixed(keys * _U64(3) + names[:, k::rows])
    return keys.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], idf: Idf) -> float:
    """Weighted Jaccard similarity of two (sorted hashes, counts) sets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    weights = idf.of(a[0][i])
    shared = float((np.minimum(a[1][i], b[1][j]) * weights).sum())
    total = float((a[1] * idf.of(a[0])).sum() + (b[1] * idf.of(b[0])).sum()) - shared
    # Sets of shingles that every document holds weigh nothing: equal ones are near, others are not.
    return shared / total if total > 0 else float(len(i) == len(a[0]) == len(b[0]))


def inverse_frequencies(texts: DataFrame, share: float) -> Idf:
    """Idf of all shingles: two passes over all documents, both counted before the shuffle."""

    def bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        n = 0
        for batch in batches:
            for raw in raw_bytes(batch.column("text")):
                found, _, _ = shingles_of(raw)
                counts += np.bincount(np.unique((found % _U64(BUCKETS)).astype(np.int64)), minlength=BUCKETS) if len(found) else 0
                n += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(counts[at], n), pa.int64())], ["key", "n"]
        )

    by_bucket = written(
        map_texts(texts, {"text": F.col("text")}, "key bigint, n bigint", bucket_counts).groupBy("key").agg(F.sum("n").alias("n")),
        "shingle-buckets",
    )
    total = by_bucket.where("key = -1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rare = 1 + math.log(1 / share)
    least = max(share * total, 1)
    heavy = np.zeros(BUCKETS, bool)
    heavy[[r.key for r in by_bucket.where((F.col("key") >= 0) & (F.col("n") > least)).select("key").collect()]] = True
    if not heavy.any():
        return Idf(rare)
    shared = texts.sparkSession.sparkContext.broadcast(np.packbits(heavy))

    def shingle_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            found = [shingles_of(raw)[0] for raw in raw_bytes(batch.column("text"))]
            every = np.concatenate([f[wanted[(f % _U64(BUCKETS)).astype(np.int64)]] for f in found] or [np.zeros(0, _U64)])
            key, n = np.unique(every, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n, pa.int64())], ["key", "n"])

    counted = map_texts(texts, {"text": F.col("text")}, "key bigint, n bigint", shingle_counts)
    common = counted.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > least)
    rows = sorted((r.key % (1 << 64), 1 + math.log(total / r.n)) for r in common.collect())
    return Idf(rare, np.array([r[0] for r in rows], _U64), np.array([r[1] for r in rows]))


def _signed(raws: list[bytes], idf: Idf, settings: Settings) -> tuple[list[str | None], list[list[int] | None], list[float]]:
    """Digest, band keys and total weight of each text; texts are signed together, some ten thousand shingles at a time."""
    members: list[str | None] = []
    totals: list[float] = []
    keys: list[list[int] | None] = []
    known: dict[str, int] = {}
    sets: list[tuple[int, np.ndarray, np.ndarray]] = []
    size = 0

    def sign() -> None:
        starts = np.cumsum([0] + [len(found) for _, found, _ in sets[:-1]])
        names = weighted_samples(
            np.concatenate([f for _, f, _ in sets]), np.concatenate([w for _, _, w in sets]), starts, settings.bands * settings.rows
        )
        for (row, _, _), found in zip(sets, band_keys(names, settings.rows).tolist(), strict=True):
            keys[row] = found

    for row, raw in enumerate(raws):
        found, counts, member = shingles_of(raw)
        members.append(member)
        keys.append(None)
        weights = counts * idf.of(found)
        totals.append(float(weights.sum()))
        if member is None or member in known:
            continue
        known[member] = row
        if (weights > 0).any():
            sets.append((row, found[weights > 0], weights[weights > 0]))
        else:
            sets.append((row, found, np.ones(len(found))))
        size += len(found)
        if size > 40000:
            sign()
            sets, size = [], 0
    if sets:
        sign()
    return members, [None if m is None else keys[known[m]] for m in members], totals


def _judged(pairs: DataFrame, texts: DataFrame, idf: Idf, threshold: float) -> DataFrame:
    """(a, b, near) for each different pair of members, from their whole texts."""
    shared_idf = pairs.sparkSession.sparkContext.broadcast(idf)
    left = texts.select(F.col("member").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("member").alias("b"), F.col("text").alias("text_b"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for one, two in zip(raw_bytes(batch.column("text_a")), raw_bytes(batch.column("text_b")), strict=True):
                near.append(similarity(shingles_of(one)[:2], shingles_of(two)[:2], shared_idf.value) >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(near, pa.bool_())], ["a", "b", "near"])

    both = pairs.join(left, "a").join(right, "b")
    inputs = {c: F.col(c) for c in ("a", "b", "text_a", "text_b")}
    return written(map_texts(both, inputs, "a string, b string, near boolean", verify), "near-pairs")


def _shared_weights(sets: list[tuple[np.ndarray, np.ndarray]], idf: Idf) -> Iterator[tuple[int, np.ndarray]]:
    """For each set but the last: its number and the weight that it shares with each later one.

    Shingles of many sets are multiplied as a matrix, all others by their postings. A shingle
    that two sets hold several times counts as often as both do.
    """
    sizes = [len(found) for found, _ in sets]
    row = np.repeat(np.arange(len(sets)), sizes)
    every, column, holders = np.unique(np.concatenate([f for f, _ in sets]), return_inverse=True, return_counts=True)
    times = np.concatenate([c for _, c in sets])
    weights = idf.of(every)
    kept = (holders[column] > 1) & (weights[column] > 0)
    row, column, times = row[kept], column[kept], times[kept]
    common = np.flatnonzero((holders > max(16, len(sets) // 16)) & (weights > 0))
    place = np.full(len(every), -1)
    place[common] = np.arange(len(common))
    dense = np.zeros((len(sets), len(common)), np.float32)
    in_dense = place[column] >= 0
    dense[row[in_dense], place[column[in_dense]]] = 1
    scaled = dense * weights[common].astype(np.float32)
    # The matrix counts each shingle once; the postings hold what it leaves out.
    times = times - in_dense
    row, column, times = row[times > 0], column[times > 0], times[times > 0]
    by_column = np.lexsort([row, column])
    row, column, times = row[by_column], column[by_column], times[by_column]
    ends = np.searchsorted(column, column, "right")
    by_row = np.argsort(row, kind="stable")
    starts = np.searchsorted(row[by_row], np.arange(len(sets) + 1))
    for k in range(len(sets) - 1):
        shared = (dense[k + 1 :] @ scaled[k]).astype(np.float64)
        own = by_row[starts[k] : starts[k + 1]]
        counts = ends[own] - own - 1
        if counts.sum():
            first = np.repeat(own + 1, counts)
            at = first + np.arange(len(first)) - np.repeat(np.cumsum(counts) - counts, counts)
            least = np.minimum(times[at], np.repeat(times[own], counts)) * weights[column[at]]
            shared += np.bincount(row[at] - k - 1, least, minlength=len(shared))
        yield k, shared


def links_within(members: list[str], roots: list[str], sides: list[int], raws: list[bytes], idf: Idf, threshold: float) -> list[tuple[str, str]]:
    """Links that connect the components of ``members`` as all near pairs do.

    Pairs within one component are left out; so are those of one side, if there are two sides.
    """
    sets = [shingles_of(raw)[:2] for raw in raws]
    totals = np.array([float((c * idf.of(f)).sum()) for f, c in sets])
    names = {name: k for k, name in enumerate(sorted(set(roots)))}
    label = np.array([names[r] for r in roots])
    side = np.array(sides)
    both = len(set(sides)) > 1
    links = []
    for k, shared in _shared_weights(sets, idf):
        union = totals[k] + totals[k + 1 :] - shared
        # A little below the threshold, as products are rounded; ``similarity`` decides.
        likely = (shared >= (threshold - 1e-3) * union) & (label[k + 1 :] != label[k])
        if both:
            likely &= side[k + 1 :] != side[k]
        for j in np.flatnonzero(likely) + k + 1:
            if label[j] != label[k] and similarity(sets[k], sets[j], idf) >= threshold:
                links.append((min(members[k], members[j]), max(members[k], members[j])))
                label[label == label[j]] = label[k]
    return links


def _star_links(rows: DataFrame, texts: DataFrame, idf: Idf, threshold: float) -> DataFrame:
    """Links of members with their groups' leaders."""
    # The same text leads all groups it can, so that most members are compared once.
    first = F.min(F.struct(F.xxhash64("member").alias("rank"), F.col("member").alias("leader")))
    leaders = rows.groupBy("group").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1").select("group", "first.leader")
    met = rows.join(leaders, "group").where("member <> leader")
    pairs = met.select(F.least("member", "leader").alias("a"), F.greatest("member", "leader").alias("b")).distinct()
    return _judged(pairs, texts, idf, threshold).where("near").select("a", "b")


def _cell_pairs(rows: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(member, root, group, cell) and the pairs (task, group, cell, other) to compare, of groups with several components."""
    # Of groups with the same members one is enough; in a group of two the pair is judged already.
    of_group = rows.groupBy("group").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("size"), F.min("root").alias("low"), F.max("root").alias("high"),
        F.sum(F.xxhash64("member").cast("decimal(38,0)")).alias("all"),
    )
    open_groups = of_group.where("n > 2 and low <> high").groupBy("n", "size", "all").agg(F.min("group").alias("group"))
    small = (F.col("n") <= CELL_ROWS) & (F.col("size") <= CELL_BYTES)
    placed = rows.join(open_groups.select("group", small.alias("small")), "group")
    # Totals of near texts are at most a factor 1 / threshold apart, so their classes are at most one apart.
    step = -math.log(threshold) * (1 + 1e-6)
    weight_class = F.when(F.col("total") > 0, F.floor(F.log("total") / step)).otherwise(F.lit(-(1 << 20))).cast("int")
    placed = placed.withColumn("class", F.when(F.col("small"), 0).otherwise(weight_class))
    by_root = placed.groupBy("group", "class", "root").agg(F.count("*").alias("n"))
    own = by_root.where(F.col("n") >= CELL_ROWS // 4)
    placed = placed.join(own.select("group", "class", "root", F.col("root").alias("only")), ["group", "class", "root"], "left")
    placed = placed.withColumn("only", F.when(~F.col("small"), F.col("only")))
    part = ["group", "class", "only"]
    cells = placed.groupBy(*part).agg(F.count("*").alias("n"), F.sum("bytes").alias("size"), F.first("small").alias("small"))
    salts = F.when(F.col("small"), 1).otherwise(F.greatest(F.ceil(F.col("n") / CELL_ROWS), F.ceil(F.col("size") / CELL_BYTES))).cast("int")
    cells = written(cells.select(*part, salts.alias("salts")), "near-cells")
    name = F.xxhash64("class", F.coalesce("only", F.lit("")), "salt")
    same = (placed["group"] == cells["group"]) & (placed["class"] == cells["class"]) & placed["only"].eqNullSafe(cells["only"])
    located = placed.join(cells, same).select(placed["member"], placed["root"], *(placed[c] for c in part), "salts")
    located = located.withColumn("salt", F.pmod(F.xxhash64("member", F.lit(7)), F.col("salts")).cast("int"))
    located = written(located.select("member", "root", "group", name.alias("cell")), "near-located")
    each = cells.select(*part, F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")).select("group", "class", "only", name.alias("cell"))
    others = each.select("group", F.col("class").alias("class_b"), F.col("only").alias("only_b"), F.col("cell").alias("other"))
    apart = (F.abs(F.col("class") - F.col("class_b")) > 1) | F.coalesce(F.col("only") == F.col("only_b"), F.lit(False))
    pairs = each.join(others, "group").where((F.col("cell") <= F.col("other")) & ~apart)
    return located, pairs.select(F.xxhash64("group", "cell", "other").alias("task"), "group", "cell", "other")


def near_links(keyed: DataFrame, texts: DataFrame, idf: Idf, settings: Settings) -> DataFrame:
    """Verified links (a, b) that connect what all near pairs that meet in a band connect.

    ``keyed``: member, keys (one for each band), total (its weight), bytes (of its text); ``texts``: member, text.
    """
    rows = keyed.select("member", "total", "bytes", F.posexplode("keys").alias("band", "key"))
    rows = rows.withColumn("group", F.xxhash64("band", "key")).drop("band", "key")
    stars = _star_links(rows, texts, idf, settings.threshold)
    roots = components(stars).withColumnRenamed("node", "member")
    rows = rows.join(roots, "member", "left").withColumn("root", F.coalesce("root", "member"))
    located, pairs = _cell_pairs(written(rows, "near-rows"), settings.threshold)
    sent = F.explode(F.when(F.col("cell") == F.col("other"), F.array(F.struct(F.col("cell").alias("cell"), F.lit(0).alias("side")))).otherwise(
        F.array(F.struct(F.col("cell").alias("cell"), F.lit(0).alias("side")), F.struct(F.col("other").alias("cell"), F.lit(1).alias("side")))
    ))
    wanted = pairs.select("task", "group", sent.alias("sent")).select("task", "group", "sent.cell", "sent.side")
    dealt = located.join(wanted, ["group", "cell"]).select("task", "side", "member", "root").join(texts, "member")
    dealt = dealt.repartition("task").sortWithinPartitions("task")
    shared_idf = keyed.sparkSession.sparkContext.broadcast(idf)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task: int | None = None
        held: tuple[list, list, list, list] = ([], [], [], [])

        def found() -> pa.RecordBatch:
            members, roots, sides, raws = held
            several = len(set(roots)) > 1
            links = links_within(members, roots, sides, raws, shared_idf.value, settings.threshold) if several else []
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.string()), pa.array([b for _, b in links], pa.string())], ["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("task", "member", "root", "side")] + [raw_bytes(batch.column("text"))]
            for at, *values in zip(*columns, strict=True):
                if at != task and held[0]:
                    yield found()
                    held = ([], [], [], [])
                task = at
                for column, value in zip(held, values, strict=True):
                    column.append(value)
        if held[0]:
            yield found()

    inputs = {c: F.col(c) for c in ("task", "member", "root", "side", "text")}
    return stars.union(written(map_texts(dealt, inputs, "a string, b string", compare), "near-links"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Per row: id, ``class_id`` (the smallest id of its class) and ``words_digest`` (equal for equal words)."""
    spark = docs.sparkSession
    kind = id_type(docs, id_col)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    inputs = {"id": F.col("id"), "text": F.col("text")}
    idf = inverse_frequencies(texts, settings.common_share)
    shared_idf = spark.sparkContext.broadcast(idf)

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members, keys, totals = _signed(raw_bytes(batch.column("text")), shared_idf.value, settings)
            columns = [pa.array(members, pa.string()), pa.array(keys, pa.list_(pa.int64())), pa.array(totals, pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "member", "keys", "total"])

    named = written(map_texts(texts, inputs, f"id {kind}, member string, keys array<bigint>, total double", signatures), "near-names")
    words = named.where("member is not null")
    each = words.groupBy("member").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("m"), F.first("keys").alias("keys"), F.first("total").alias("total"))
    each = written(each.select("member", "m.id", "keys", "total"), "near-keys")
    bands = each.select("member", F.posexplode("keys").alias("band", "key"))
    # Texts alone in all their buckets can have no link; only the others go on.
    busy = bands.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    meeting = each.join(bands.join(busy, ["band", "key"], "left_semi").select("member").distinct(), "member", "left_semi")
    meeting = written(meeting, "near-meeting")
    found = texts.join(meeting, texts["id"].eqNullSafe(meeting["id"])).select("member", "text")  # an id may have other texts too

    def with_that_member(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("member").to_pylist(), raw_bytes(batch.column("text")), strict=True)
            yield batch.filter(pa.array([shingles_of(raw)[2] == member for member, raw in pairs], pa.bool_()))

    checked = map_texts(found, {"member": F.col("member"), "text": F.col("text")}, "member string, text string", with_that_member)
    one_text = written(checked.dropDuplicates(["member"]), "near-texts")
    sized = one_text.select("member", F.octet_length("text").alias("bytes"))
    classes = components(near_links(meeting.select("member", "keys", "total").join(sized, "member"), one_text, idf, settings))

    rooted = named.join(classes.withColumnRenamed("node", "member"), "member", "left").select(
        "id", "member", F.coalesce("root", "member").alias("root")
    )
    smallest = rooted.where("root is not null").groupBy("root").agg(F.min("id").alias("class_id"), F.count("*").alias("n"))
    many = written(smallest.where("n > 1"), "near-classes")
    # A class may hold a third of all rows: its rows are spread over salts.
    of_row = lookup_join(rooted, many.drop("n"), ["root"], heavy_keys(many, "root", "n"), ["id"])
    return of_row.select(
        F.col("id").alias(id_col), F.coalesce("class_id", "id").alias("class_id"), F.col("member").alias("words_digest")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with one row of each class: the one with its smallest id (one of its rows, if repeated)."""
    found = near_duplicates(docs, id_col, text_col, settings)
    first = found.where(F.col("class_id").eqNullSafe(F.col(id_col))).groupBy(F.col(id_col).alias("kept_id"), F.col("words_digest").alias("kept_digest"))
    first = first.agg(F.count("*").alias("rows"))
    # The text is sent to the workers once, apart from the other columns.
    others = [c for c in docs.columns if c != text_col]
    packed = docs.select(F.struct(*(others or [id_col])).alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = packed.schema["row"].dataType.simpleString()
    id_kind = id_type(docs, id_col)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles_of(raw)[2] for raw in raw_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(found, pa.string()), batch.column("text")], ["row", "id", "member", "text"]
            )

    inputs = {c: F.col(c) for c in ("row", "id", "text")}
    named = map_texts(packed, inputs, f"row {kind}, id {id_kind}, member string, text string", digests)
    same = named["id"].eqNullSafe(first["kept_id"]) & named["member"].eqNullSafe(first["kept_digest"])
    kept = named.join(first, same).select(F.struct("row", "text").alias("row"), "id", "member", "rows")
    single = (F.col("rows") == 1) | F.col("member").isNull()
    repeated = kept.where(~single).groupBy("id", "member").agg(F.first("row").alias("row"))
    rows = kept.where(single).select("row").union(repeated.select("row"))
    return rows.select(*(F.col("row.text" if c == text_col else f"row.row.`{c}`").alias(c) for c in docs.columns))
