"""Near-duplicate detection by order MinHash.

A text is the sequence of its 5-word shingles, each labelled with its
occurrence number, so repeats count. One sketch hashes all labelled shingles
with its own seed, takes the ``take`` smallest and folds them together *in
text order*: two texts agree on a sketch if they share those shingles and
hold them in the same order, which follows edit similarity rather than mere
overlap. Texts that agree on any sketch are candidates.

A candidate pair is verified by banded alignment of the two shingle
sequences: equal labelled shingles are chained in increasing position of
both texts, within the band that the threshold leaves, and the pair is a
link when ``aligned / (n_a + n_b - aligned) >= 0.8``. Without reordering this
is the Jaccard similarity of the shingles.

At scale. Equal word sequences collapse to one representative first. Within
a band no pairs are listed: its most connected text (the one that shares
most sketches overall, as the original of a group of copies does) is
compared with every other member, which is linear in the band, and only
bands whose members are not yet connected go on to the next such hub. Small
bands are finished completely, pair by pair of still separate classes, in
the second round. What the hubs leave open is finished by an exact filter:
two texts at the threshold share one of their rarest shingles, so only
pairs of separate classes that do, and whose lengths allow it, are verified."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectio.llm.common import new_name, written
from lectio.llm.components import components

SHINGLE, THRESHOLD = 5, 0.8
#: Sketches per text and shingles per sketch: a pair at the threshold agrees
#: on one with probability 1 - (1 - 0.8**5)**24 = 0.9999.
N_SKETCHES, TAKE = 24, 5
#: Texts of few shingles, of which five are too many to agree on, get these too.
SHORT, SHORT_SKETCHES, SHORT_TAKE = 16, 16, 2
#: Bands up to this size are finished pair by pair; larger ones by hubs, and
#: after these rounds by rare shingles.
SMALL_BAND, HUB_ROUNDS = 16, 4
#: Counters for the frequency of shingles, and classes of one shingle that a
#: task compares with the shingle's others.
COUNTERS, BLOCK = 1 << 20, 256
#: Share of a text's shingles, the rarest, whose order is compared before texts are.
HEAD = 0.4

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles in text order, plain and labelled with the
    occurrence number. A text of one to four words is one shingle."""
    k = min(SHINGLE, len(words))
    if not k:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(h) - k + 1
    plain = h[:n].copy()
    for i in range(1, k):
        plain = plain * _GOLDEN + h[i:i + n]
    plain = _mix(plain)
    order = np.argsort(plain, kind="stable")
    ranked = plain[order]
    fresh = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    if fresh.all():
        return plain, _mix(plain)
    first = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    occurrence = np.empty(n, np.uint64)
    occurrence[order] = np.arange(n) - first
    return plain, _mix(plain + _GOLDEN * occurrence)


def sketch(plain: np.ndarray, labelled: np.ndarray, count: int, take: int, family: int) -> list[int]:
    """``count`` values of one family of sketches."""
    n = len(plain)
    seeds = _mix(np.arange(1, count + 1, dtype=np.uint64) * _GOLDEN + np.uint64(family))
    out = np.empty(count, np.uint64)
    step = max(1, 4_000_000 // n)  # sketches at once, to bound memory for long texts
    for at in range(0, count, step):
        own = seeds[at:at + step]
        hashed = _mix(labelled[None, :] ^ own[:, None])
        if n > take:
            smallest = np.sort(np.argpartition(hashed, take - 1, axis=1)[:, :take], axis=1)
        else:
            smallest = np.broadcast_to(np.arange(n), (len(own), n))
        value = own
        for j in range(smallest.shape[1]):
            value = _mix(value * _GOLDEN + plain[smallest[:, j]])
        out[at:at + step] = value
    return out.view(np.int64).tolist()


def sketches(words: list[bytes]) -> list[int]:
    plain, labelled = shingles(words)
    if not len(plain):
        return []
    found = sketch(plain, labelled, N_SKETCHES, TAKE, 1)
    if len(plain) <= SHORT:
        found += sketch(plain, labelled, SHORT_SKETCHES, SHORT_TAKE, 2)
    return sorted(set(found))


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Similarity of two sequences of labelled shingles by banded chaining.
    Below the threshold the value is an upper bound."""
    n = len(a) + len(b)
    if not len(a) or not len(b):
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(i) < threshold * (n - len(i)):
        return len(i) / (n - len(i))
    band = max(len(a), len(b)) - threshold / (1 + threshold) * n
    order = np.argsort(i)
    i, j = i[order], j[order]
    j = j[np.abs(i - j) <= band]
    if (np.diff(j) > 0).all():
        m = len(j)
    else:
        tails: list[int] = []
        for x in j.tolist():
            at = bisect_left(tails, x)
            if at == len(tails):
                tails.append(x)
            else:
                tails[at] = x
        m = len(tails)
    return m / (n - m)


_SKETCHED = T.StructType([T.StructField("seq", T.StringType()), T.StructField("sketches", T.ArrayType(T.LongType()))])


@F.pandas_udf(_SKETCHED)
def _sketched(texts: pd.Series) -> pd.DataFrame:
    seq, found = [], []
    for text in texts:
        words = words_of(text)
        seq.append(xxhash.xxh3_128_hexdigest(b" ".join(words)) if words else None)
        found.append(sketches(words))
    return pd.DataFrame({"seq": seq, "sketches": found})


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b) -> (a, b, similarity) with the texts of (row, text)."""
    left = texts.select(F.col("row").alias("b"), F.col("text").alias("text_b"))
    right = texts.select(F.col("row").alias("a"), F.col("text").alias("text_a"))
    both = pairs.join(left, "b").join(right, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_row, known = None, None  # pairs arrive sorted by a
        for batch in batches:
            found = []
            for row, text_a, text_b in zip(batch.column("a").to_pylist(), batch.column("text_a"), batch.column("text_b"),
                                           strict=True):
                if row != known_row:
                    known_row, known = row, shingles(words_of(text_a.as_py()))[1]
                found.append(aligned(known, shingles(words_of(text_b.as_py()))[1], threshold))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found, pa.float64())],
                                             ["a", "b", "similarity"])

    return both.mapInArrow(run, "a long, b long, similarity double")


def _labelled(texts: DataFrame) -> DataFrame:
    """(row, text) -> (row, tokens): the labelled shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(words_of(t.as_py()))[1].view(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.list_(pa.int64()))], ["row", "tokens"])

    return texts.select("row", "text").mapInArrow(run, "row long, tokens array<long>")


def prefix_pairs(members: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b) of ``members`` (row, class), in different classes, among which
    are all pairs at the threshold.

    Shingles are ordered by frequency, rare ones first (any order is exact).
    A pair at the threshold t shares at least ``t / (1 + t) * (n_a + n_b)``
    shingles, so its first common one is among the first ``n - t * n`` and
    one of the longer text and ``n - 2 * t / (1 + t) * n`` and one of the
    shorter. Shingles meet by class first, in blocks, so that a large class
    is never compared with itself. Only shingles that the alignment's band
    allows to be aligned count, and :func:`_in_order` then compares the order
    of more of them."""
    spark = members.sparkSession
    tokens = written(_labelled(texts.join(members.select("row").hint("merge"), "row", "left_semi")), "omh-labelled")
    counted = (tokens.select(F.explode("tokens").alias("t")).groupBy(F.col("t").bitwiseAND(F.lit(COUNTERS - 1)).alias("at"))
               .count().toArrow())
    often = np.zeros(COUNTERS, np.int64)
    often[counted.column("at").to_numpy()] = counted.column("count").to_numpy()
    often = spark.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, short, long = [], [], []
            for row in batch.column("tokens"):
                own = row.values.to_numpy()
                n.append(len(own))
                order = np.lexsort((own, often.value[own & (COUNTERS - 1)]))[:math.ceil(HEAD * len(own))]
                short.append(len(own) - math.ceil(threshold * len(own) - 1e-6) + 1)
                long.append([{"token": t, "place": at} for t, at in zip(own[order].tolist(), order.tolist())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n, pa.int64()), pa.array(short, pa.int32()),
                 pa.array(long, pa.list_(pa.struct([("token", pa.int64()), ("place", pa.int64())])))], ["row", "n", "short", "head"])

    heads = written(tokens.mapInArrow(run, "row long, n long, short int, head array<struct<token: long, place: long>>"), "omh-heads")
    prefixes = heads.select("row", "n", F.posexplode(F.slice("head", F.lit(1), F.col("short"))).alias("pos", "t")).join(members, "row")
    every = written(prefixes.select("row", "class", "n", "pos", "t.token", "t.place"), "omh-prefixes")
    split = written(every.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high"),
                                               F.count(F.lit(1)).alias("size"))
                    .where("low <> high").select("token", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "omh-rare")
    probe = written(every.join(split, "token"), "omh-meeting")
    share = threshold / (1 + threshold)
    index = probe.where(F.col("pos") <= F.col("n") - F.ceil(2 * share * F.col("n") - 1e-6))
    one = probe.select("token", F.col("class").alias("class_a"),
                       F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int").alias("block")).distinct()
    two = (index.select("token", F.col("class").alias("class_b"), "blocks").distinct()
           .select("token", "class_b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
    meet = one.join(two, ["token", "block"]).where("class_a <> class_b").select("token", "class_a", "class_b")
    longer = probe.select("token", F.col("class").alias("class_a"), F.col("row").alias("a"), F.col("n").alias("n_a"),
                          F.col("pos").alias("pos_a"), F.col("place").alias("place_a"))
    shorter = index.select("token", F.col("class").alias("class_b"), F.col("row").alias("b"), F.col("n").alias("n_b"),
                           F.col("pos").alias("pos_b"), F.col("place").alias("place_b"))
    a, b = F.struct("n_a", "a"), F.struct("n_b", "b")
    possible = ((F.col("n_b") >= threshold * F.col("n_a") - 1e-6) & (F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
                                                                    >= share * (F.col("n_a") + F.col("n_b")) - 1e-6))
    near = F.abs(F.col("place_a") - F.col("place_b")) <= F.greatest("n_a", "n_b") - share * (F.col("n_a") + F.col("n_b")) + 1e-6
    found = meet.join(longer, ["token", "class_a"]).join(shorter, ["token", "class_b"]).where((a > b) & possible & near)
    pairs = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return _in_order(pairs, heads, threshold)


def _in_order(pairs: DataFrame, heads: DataFrame, threshold: float) -> DataFrame:
    """The ``pairs`` whose heads allow an alignment at the threshold.

    A head is a text's rarest shingles, ``HEAD`` of all, with their places.
    At the threshold at most ``u = n - t / (1 + t) * (n_a + n_b)`` shingles
    of a text are not aligned, so of the aligned ones both heads hold
    ``min(head - u)`` at least, and those are within the alignment's band of
    each other. Texts that hold the same passages in another order share
    everything but fail this, before any text is fetched."""
    share = threshold / (1 + threshold)
    left = heads.select(F.col("row").alias("a"), F.col("n").alias("n_a"), F.col("head").alias("head_a"))
    right = heads.select(F.col("row").alias("b"), F.col("n").alias("n_b"), F.col("head").alias("head_b"))

    def split(head: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
        return head.values.field("token").to_numpy(), head.values.field("place").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n_a, n_b, one, two in zip(batch.column("n_a").to_pylist(), batch.column("n_b").to_pylist(), batch.column("head_a"),
                                          batch.column("head_b"), strict=True):
                least = share * (n_a + n_b)
                (tokens_a, places_a), (tokens_b, places_b) = split(one), split(two)
                _, i, j = np.intersect1d(tokens_a, tokens_b, assume_unique=True, return_indices=True)
                close = np.abs(places_a[i] - places_b[j]) <= max(n_a, n_b) - least + 1e-6
                keep.append(int(close.sum()) >= min(len(tokens_a) - (n_a - least), len(tokens_b) - (n_b - least)) - 1e-6)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "head_a", "head_b")
    return both.mapInArrow(run, "a long, b long")


def _merge(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Classes after joining those that a link connects."""
    a = classes.select(F.col("row").alias("a"), F.col("class").alias("u"))
    b = classes.select(F.col("row").alias("b"), F.col("class").alias("v"))
    roots = components(links.join(a, "a").join(b, "b").select("u", "v"))
    joined = classes.join(roots, F.col("class") == F.col("node"), "left")
    return written(joined.select("row", F.coalesce("component", "class").alias("class")), "omh-classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    small_band: int = SMALL_BAND, hub_rounds: int = HUB_ROUNDS) -> DataFrame:
    """One row per row of ``docs``: id, ``class_id`` (smallest id of its
    class), ``class_size``, ``kept`` (the row that stays: the smallest id)
    and ``text_key`` (hash of the raw text, to tell rows that repeat an id
    apart). Classes are the connected components of the links.

    Texts without a word (null, empty, white space) link to nothing, each is
    a class of its own. Equal word sequences, letter case of A-Z aside, are
    one class at any length. Null ids sort last; of rows that repeat id and
    text exactly one stays. An empty table gives no rows."""
    s = _sketched(F.col(text_col))
    rows = written(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), s.alias("s")).select(
        F.monotonically_increasing_id().alias("row"), "id", "text", F.xxhash64("text").alias("text_key"), "s.seq", "s.sketches"),
        "omh-rows")
    # one representative for each word sequence, and its bands that others share
    reps = written(rows.where("seq is not null").groupBy("seq").agg(F.min(F.struct("row", "sketches")).alias("r"))
                   .select("seq", "r.row", "r.sketches"), "omh-representatives")
    entries = reps.select("row", F.explode("sketches").alias("band"))
    sizes = written(entries.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "omh-sizes")
    shared = written(entries.join(sizes, "band"), "omh-bands")
    reach = shared.groupBy("row").agg(F.sum("size").alias("reach"))
    bands = written(shared.join(reach, "row"), "omh-entries")
    # the candidates grow with the corpus: this join never broadcasts them
    texts = written(rows.select("row", "text").join(reach.select("row").hint("merge"), "row", "left_semi"), "omh-texts")
    classes = written(reach.select("row", F.col("row").alias("class")), "omh-classes")
    failed = None
    for step in range(hub_rounds + 1):
        entry = bands.join(classes, "row")
        hubs = written(entry.groupBy("band").agg(F.max(F.struct("reach", "row", "class")).alias("hub"),
                                                 F.min("class").alias("low"), F.max("class").alias("high"))
                       .where("low <> high").select("band", "hub"), "omh-hubs")
        entry = written(entry.join(hubs, "band"), "omh-open")
        if entry.isEmpty():
            break
        complete = F.lit(step > 0) & (F.col("size") <= small_band)
        if step == hub_rounds:
            pairs = prefix_pairs(entry.select("row", "class").distinct(), texts, threshold)
        else:
            pairs = (entry.where(~complete & (F.col("class") != F.col("hub.class")))
                     .select(F.col("hub.row").alias("a"), F.col("row").alias("b")))
            if step:
                one = entry.where(complete).select("band", F.col("row").alias("a"), F.col("class").alias("class_a"))
                two = entry.where(complete).select(F.col("band").alias("band_b"), F.col("row").alias("b"), F.col("class").alias("class_b"))
                every = one.join(two, (F.col("band") == F.col("band_b")) & (F.col("a") < F.col("b")) & (F.col("class_a") != F.col("class_b")))
                pairs = pairs.unionByName(every.select("a", "b"))
        pairs = pairs.distinct()
        if failed is not None:
            pairs = pairs.join(failed, ["a", "b"], "left_anti")
        checked = written(verified(pairs, texts, threshold), "omh-checked")
        links = checked.where(F.col("similarity") >= threshold).select("a", "b")
        misses = checked.where(F.col("similarity") < threshold).select("a", "b")
        failed = misses if failed is None else failed.unionByName(misses)
        classes = _merge(classes, links)
        bands = entry.where(~complete & (F.col("row") != F.col("hub.row"))).select("band", "row", "size", "reach")
    of_seq = written(reps.select("seq", "row").join(classes, "row", "left").select("seq", F.coalesce("class", "row").alias("class")),
                     "omh-class-of")
    placed = written(rows.select("row", "id", "text_key", "seq").join(of_seq, "seq", "left")
                     .select("row", "id", "text_key", F.coalesce("class", "row").alias("class")), "omh-placed")
    first = written(placed.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"),
                                                F.count(F.lit(1)).alias("class_size")), "omh-firsts")
    return placed.join(first, "class").select(
        F.col("id").alias(id_col), F.col("first.id").alias("class_id"), "class_size",
        (F.col("row") == F.col("first.row")).alias("kept"), "text_key")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one of each class."""
    found = near_duplicates(docs, id_col, text_col)
    kept = found.where("kept").select(F.col(id_col).alias("id"), F.col("text_key").alias("key")).alias("k")
    key = new_name(docs, "text_key")
    own = docs.withColumn(key, F.xxhash64(text_col)).alias("d")
    stay = own.join(kept, F.col(f"d.{id_col}").eqNullSafe(F.col("k.id")) & (F.col(f"d.{key}") == F.col("k.key")), "left_semi")
    if not found.where(~F.col("kept") & F.col(id_col).eqNullSafe(F.col("class_id"))).isEmpty():
        stay = stay.dropDuplicates([id_col, key])
    return stay.drop(key)
