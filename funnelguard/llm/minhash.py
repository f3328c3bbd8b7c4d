"""MinHash near-dedup by one-permutation hashing with optimal densification (operator 12).

A document's set are the hashes of its distinct word shingles; equal sets are
one class. One permutation (the order of the hashes) gives the signature: the
range of hashes is cut into bins, and a bin's value is its least hash. An
empty bin takes the value of another one of the same set, found along a fixed
random order of the bins that is its own (optimal densification). Bands of
values are hashed to buckets.

Within a bucket candidate edges form stars: members go to a centre, never to
each other. A bucket of very many members is cut into stars of about
``STAR_ROWS`` whose centres form a star. Every candidate is confirmed on the
full sets. Two rounds of stars join nearly all that is linked; the second
takes its centres from each bucket's largest component. What a star cannot
see, two members that are linked to each other but not to a centre, is
settled exactly: the members outside a bucket's largest component are
compared with all members, in cells of bounded size, from which only links
come out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import stars
from .work import id_and_text, id_type, stored, workspace

SHINGLE_WORDS, PERCENT = 3, 85
#: Bands, and values in a band: two sets of likeness 0.85 share no bucket with a chance of 7e-9.
BANDS, BAND_VALUES, SEED = 32, 5, 12
#: Members of a star before a bucket is cut, and of either side of a cell.
STAR_ROWS, CELL_ROWS = 1024, 1024


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and each text's number of words; A-Z count as a-z, words are parted by ASCII white space."""
    from xxhash import xxh64_intdigest

    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    sizes, words = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten()
    empty = pc.binary_length(words).to_numpy(zero_copy_only=False) == 0  # before and after white space at the edges
    if empty.any():
        sizes = sizes - np.bincount(np.repeat(np.arange(len(sizes)), sizes)[empty], minlength=len(sizes))
        words = words.filter(pa.array(~empty))
    found = words.dictionary_encode()
    if not len(found.dictionary):
        return np.zeros(0, np.uint64), sizes
    hashes = np.array([xxh64_intdigest(w) for w in found.dictionary.cast(pa.binary()).to_pylist()], np.uint64)
    return hashes[found.indices.to_numpy(zero_copy_only=False)], sizes


def shingle_sets(texts: pa.Array, words_each: int) -> list[np.ndarray]:
    """Each text's ascending hashes of its distinct shingles; fewer words are one shingle, none give an empty set."""
    hashes, sizes = word_hashes(texts)
    ends = np.cumsum(sizes)
    joined = np.zeros(len(hashes), np.uint64)
    for j in range(words_each):
        # the order of the words counts: each place has a multiplier of its own
        joined[: len(hashes) - j] = _mixed(joined[: len(hashes) - j] + hashes[j:] * np.uint64(2 * j + 3))
    found = []
    for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        if b - a >= words_each:
            found.append(np.unique(joined[a: b - words_each + 1]))
        elif b > a:
            one = np.array([b - a], np.uint64)
            for h in hashes[a:b]:
                one = _mixed(one + h)
            found.append(one)
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def set_key(hashes: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(hashes.tobytes())


def ways(bins: int) -> np.ndarray:
    """For each bin the order in which it looks at all bins for one that is not empty."""
    return np.random.default_rng(SEED).permuted(np.tile(np.arange(bins), (bins, 1)), axis=1)


def signatures(sets: list[np.ndarray], bins: int, order: np.ndarray) -> np.ndarray:
    """Sets by bins: the least hash of each bin, empty bins filled along ``order``. No set is empty."""
    which = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    bin_of = ((flat >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    cell = which * bins + bin_of
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
    values = np.zeros(len(sets) * bins, np.uint64)
    full = np.zeros(len(sets) * bins, bool)
    values[cell[first]] = flat[first]
    full[cell[first]] = True
    empty, step = np.flatnonzero(~full), 0
    base, own = empty // bins * bins, empty % bins
    while len(empty):
        other = base + order[own, step]
        hit = full[other]
        values[empty[hit]] = values[other[hit]]
        empty, base, own, step = empty[~hit], base[~hit], own[~hit], step + 1
    return values.reshape(len(sets), bins)


def band_keys(table: np.ndarray, bands: int, values: int) -> np.ndarray:
    """Sets by bands: 64 bits of hash of a band's number and values."""
    cut = table[:, : bands * values].reshape(len(table), bands, values)
    key = np.tile(_mixed(np.arange(1, bands + 1, dtype=np.uint64)), (len(table), 1))
    for j in range(values):
        key = _mixed(key ^ cut[:, :, j])
    return key.view(np.int64)


def signed(docs: DataFrame, words_each: int = SHINGLE_WORDS, bands: int = BANDS, values: int = BAND_VALUES, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, key (128 bits of the set) and bands (array of bucket numbers); of an empty set key and bands are null."""
    kind = id_type(docs, id_col)
    order = ways(bands * values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1), words_each)
            some = [s for s in sets if len(s)]
            keys = iter(band_keys(signatures(some, bands * values, order), bands, values).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                 pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64()))], ["doc_id", "n_shingles", "key", "bands"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_shingles long, key binary, bands array<long>")


def wanted_sets(docs: DataFrame, wanted: DataFrame, words_each: int, id_col: str, text_col: str) -> DataFrame:
    """c and hashes of the classes ``wanted`` (c, key, least: a document that has the set), from those documents alone."""
    texts = id_and_text(docs, id_col, text_col)
    chosen = texts.join(wanted.select("least").distinct(), texts["doc_id"].eqNullSafe(F.col("least")), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for s in shingle_sets(batch.column(0), words_each) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.binary()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], ["key", "hashes"])

    # rows that share a doc_id, or have none, may hold other sets, or one set twice
    return chosen.mapInArrow(run, "key binary, hashes binary").join(wanted.select("key", "c"), "key").dropDuplicates(["c"]).select("c", "hashes")


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= ``percent`` * union of two ascending sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def confirmed(edges: DataFrame, sets: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Those of the edges (a, b) whose full sets are alike; sizes that are too far apart are left out before any set is fetched."""
    near = (edges.filter("a <> b").distinct()
            .join(sizes.select(F.col("c").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("c").alias("b"), F.col("n").alias("nb")), "b")
            .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")).select("a", "b"))
    both = (near.join(sets.select(F.col("c").alias("b"), F.col("hashes").alias("of_b")), "b")
            .join(sets.select(F.col("c").alias("a"), F.col("hashes").alias("of_a")), "a").select("a", "b", "of_a", "of_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hold = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                    for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(hold, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def star_edges(members: DataFrame, star_rows: int, folder: str) -> DataFrame:
    """a, b: each member (bucket, c, many) to the centre of its star, and the centres of a bucket to one of them."""
    # about the square root of very many members, so that neither kind of star grows with them
    size = F.greatest(F.lit(star_rows), F.sqrt("many"))
    dealt = members.withColumn("part", F.pmod(F.xxhash64("c", "bucket"), F.ceil(F.col("many") / size).cast("long")))
    centres = stored(dealt.groupBy("bucket", "part").agg(F.min_by("c", F.xxhash64("bucket", "c")).alias("a")), f"{folder}/centres")
    tops = stored(centres.groupBy("bucket").agg(F.min_by("a", F.xxhash64("bucket", "a")).alias("top"), F.count("*").alias("stars"))
                  .filter("stars > 1"), f"{folder}/tops")
    return dealt.join(centres, ["bucket", "part"]).select("a", F.col("c").alias("b")).unionByName(
        centres.join(tops, "bucket").select(F.col("top").alias("a"), F.col("a").alias("b")))


def with_component(members: DataFrame, star: DataFrame) -> DataFrame:
    return members.join(star, F.col("c") == F.col("u"), "left").select("bucket", "c", "many", F.coalesce("v", "c").alias("comp"))


def largest(placed: DataFrame, folder: str) -> DataFrame:
    """bucket, main (the component of most members) and a member of it, of buckets that span several components."""
    counted = stored(placed.groupBy("bucket", "comp").agg(
        F.count("*").alias("rows"), F.max_by("c", F.xxhash64("c", "bucket")).alias("rep")), f"{folder}/counted")
    return stored(counted.groupBy("bucket").agg(
        F.max_by(F.struct("comp", "rep"), F.struct("rows", "comp")).alias("top"), F.count("*").alias("comps"), F.sum("rows").alias("rows"),
        F.max("rows").alias("inside")).filter("comps > 1").select(
            "bucket", F.col("top.comp").alias("main"), F.col("top.rep").alias("rep"), (F.col("rows") - F.col("inside")).alias("outside")),
        f"{folder}/largest")


def cell_links(placed: DataFrame, tops: DataFrame, sets: DataFrame, percent: int, cell_rows: int, folder: str) -> DataFrame:
    """a, b: links between the components of a bucket, enough of them to join all that are linked.

    The members outside the largest component (side 0) are compared with all members (side 1), dealt to cells of about
    ``cell_rows`` of either side; a bucket of two was settled by its star.
    """
    rows = placed.filter("many > 2").join(tops, "bucket").withColumns({
        "across": F.ceil(F.col("outside") / cell_rows).cast("long"), "down": F.ceil(F.col("many") / cell_rows).cast("long")})
    left = rows.filter("comp <> main").select("bucket", "c", "comp", F.lit(0).alias("side"),
                                              F.pmod(F.xxhash64("c"), "across").alias("x"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("down") - 1)).alias("y"))
    right = rows.select("bucket", "c", "comp", F.lit(1).alias("side"),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.col("across") - 1)).alias("x"), F.pmod(F.xxhash64("c"), "down").alias("y"))
    dealt = stored(left.unionByName(right), f"{folder}/dealt").join(sets, "c")

    def found(side: np.ndarray, c: np.ndarray, comp: np.ndarray, held: list[np.ndarray]) -> list[tuple[int, int]]:
        lefts, rights = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(lefts) or not len(rights):
            return []
        sizes = np.array([len(h) for h in held])
        known, places = np.unique(np.concatenate([held[i] for i in rights]), return_inverse=True)
        owner = np.repeat(np.arange(len(rights)), sizes[rights])
        order = np.argsort(places, kind="stable")
        cuts = np.searchsorted(places[order], np.arange(len(known) + 1))
        owner, out = owner[order], []
        root = {k: k for k in np.unique(comp).tolist()}

        def top(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for i in lefts:
            at = np.searchsorted(known, held[i])
            at = at[(at < len(known)) & (known[np.minimum(at, len(known) - 1)] == held[i])]
            if len(at):
                both = np.bincount(np.concatenate([owner[cuts[k]:cuts[k + 1]] for k in at.tolist()]), minlength=len(rights))
                hits = rights[100 * both >= percent * (sizes[i] + sizes[rights] - both)]
                for j in hits.tolist():
                    p, q = top(int(comp[i])), top(int(comp[j]))
                    if p != q:
                        root[max(p, q)] = min(p, q)
                        out.append((int(c[i]), int(c[j])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now = None

        def done() -> pa.RecordBatch:
            links = found(*(np.array(x) for x in list(zip(*held, strict=True))[:3]), [np.frombuffer(h[3], np.uint64) for h in held])
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["a", "b"])

        for batch in batches:
            for bucket, x, y, *row in zip(*(k.to_pylist() for k in batch.columns), strict=True):
                if (bucket, x, y) != now:
                    if held:
                        yield done()
                    held, now = [], (bucket, x, y)
                held.append(tuple(row))
        if held:
            yield done()

    keyed = dealt.select("bucket", "x", "y", "side", "c", "comp", "hashes")
    return keyed.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words_each: int = SHINGLE_WORDS, percent: int = PERCENT, bands: int = BANDS, values: int = BAND_VALUES,
                    id_col: str = "doc_id", text_col: str = "text", star_rows: int = STAR_ROWS, cell_rows: int = CELL_ROWS,
                    folder: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id reachable) and kept.

    Documents link when 100 * intersection >= ``percent`` * union of their sets of ``words_each``-word shingles. Texts
    without words (null, empty, white space) link with nothing and are kept. Rows of equal sets are linked, repeated
    rows too; rows that share the smallest doc_id are all kept. A null doc_id is passed over in the smallest: such a row
    is kept only where its whole component has none (component_id null). An empty table gives no rows.
    """
    folder = folder or workspace(docs.sparkSession, "minhash")
    table = stored(signed(docs, words_each, bands, values, id_col, text_col), f"{folder}/signed")
    classes = stored(table.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")).withColumn(
            "c", F.monotonically_increasing_id()), f"{folder}/classes")
    buckets = classes.select("c", F.explode("bands").alias("bucket"))
    counted = stored(buckets.groupBy("bucket").agg(F.count("*").alias("many")).filter("many > 1"), f"{folder}/counts")
    members = stored(buckets.join(counted, "bucket").select("bucket", "c", "many"), f"{folder}/members")
    wanted = stored(classes.join(members.select("c").distinct(), "c", "left_semi").select("c", "key", "least", "n"), f"{folder}/wanted")
    sets = stored(wanted_sets(docs, wanted, words_each, id_col, text_col), f"{folder}/sets")

    links = stored(confirmed(star_edges(members, star_rows, f"{folder}/first"), sets, wanted, percent), f"{folder}/links-1")
    placed = stored(with_component(members, stars(links, f"{folder}/stars-1")), f"{folder}/placed-1")
    tops = largest(placed, f"{folder}/second")
    again = placed.select("bucket", "c", "comp").join(tops, "bucket").filter("comp <> main").select(F.col("rep").alias("a"), F.col("c").alias("b"))
    links = links.unionByName(stored(confirmed(again, sets, wanted, percent), f"{folder}/links-2"))

    placed = stored(with_component(members, stars(links, f"{folder}/stars-2")), f"{folder}/placed-2")
    rest = stored(cell_links(placed, largest(placed, f"{folder}/third"), sets, percent, cell_rows, f"{folder}/cells"), f"{folder}/links-3")
    star = stars(links.unionByName(rest), f"{folder}/stars-3")

    rooted = stored(classes.join(star, F.col("c") == F.col("u"), "left").select("key", "least", F.coalesce("v", "c").alias("root")), f"{folder}/rooted")
    # kept apart, so that both sides of the join are shuffles that a skewed key can be split in
    lowest = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), f"{folder}/lowest")
    labels = stored(rooted.join(lowest, "root").select("key", "component_id"), f"{folder}/labels")
    own = table.filter("key IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    found = table.filter("key IS NOT NULL").join(labels, "key").select("doc_id", "n_shingles", "component_id").unionByName(own)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
