"""Document fingerprints by winnowing (operator 6), in DataFrame and SQL functions only.

The characters of a text without its white space are hashed k in a row, at
every character, and of each window of w hashes the least is chosen, the
rightmost of equal ones, with its position. Two texts that share w + k - 1
characters in a row therefore share a chosen hash, wherever those stand, and
none is chosen from fewer than k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .work import id_and_text, parts, stored, workspace

#: Characters hashed together, and hashes in a window (a power of two).
CHARS, CHAR_WINDOW = 24, 16
#: Bytes of a character in UTF-32, and the low bits of a hash that give way to the place of its first byte, from 1.
WIDE, BYTES = 4, (1 << 31) - 1
#: Windows looked at together: what is held of a text at a time, beside its characters and what is chosen.
SEGMENT = 1 << 14
#: Documents in one range of ids, and ranges at most: their first ids are broadcast. Beyond that ranges take more documents.
DOCS_PER_RANGE, MOST_RANGES = 1_000, 1 << 14


def bare(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", "")


def let(value: Column, use) -> Column:
    """``use`` of ``value``, which is worked out once: as a variable of a function it is not copied or repeated at each use."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def with_chosen_chars(rows: DataFrame, text: str, put: str, chars: int = CHARS, window: int = CHAR_WINDOW,
                      segment: int = SEGMENT) -> DataFrame:
    """``rows`` and a column ``put``: array<struct<hash, pos, at>>, the chosen k-grams of characters of column ``text``.

    Positions count characters that are not white space, from 0; ``at`` is the first window that has chosen the
    k-gram. A text of fewer than ``chars`` characters is hashed as one k-gram; one of fewer hashes than ``window`` has
    one window; one without characters (empty, white space) has an empty array, a null none. Hashes are compared by their upper 33 bits and
    then by position, from the right. Windows are looked at in segments of ``segment``, one after the other, so that
    only what is chosen takes memory with the length of a text; the result does not depend on it.
    """
    if window < 1 or window & (window - 1):
        raise ValueError(f"the window is a power of two, not {window}")

    def gram(whole: Column, place: Column) -> Column:
        # characters are all as wide, so that a k-gram is cut out without a walk from the start
        return F.xxhash64(F.substring(whole, place, F.lit(WIDE * chars)))

    def place(x: Column) -> Column:
        return (F.lit(BYTES) - x.bitwiseAND(F.lit(BYTES))).cast("int")

    def pos(x: Column) -> Column:
        return F.floor((place(x) - 1) / WIDE).cast("int")

    def least(keys: Column, width: int, use) -> Column:
        # the least of twice as many hashes at each step; past the end there is null, which least() passes over
        if width == window:
            return use(keys)
        return let(F.transform(keys, lambda x, i: F.least(x, F.get(keys, i + width))), lambda wider: least(wider, 2 * width, use))

    def chosen(b: Column, grams: Column, s: Column) -> Column:
        # a segment starts one window before its own, whose choice its first one is compared with and which is dropped at the end
        first = F.greatest(F.lit(0), s * segment - 1)
        end = F.least(grams, (s + 1) * segment + (window - 1))
        keys = F.transform(F.sequence(first * WIDE + 1, end * WIDE - (WIDE - 1), F.lit(WIDE)),
                           lambda j: gram(b, j).bitwiseOR(F.lit(BYTES)) - j)
        full = F.greatest(F.lit(0), end - first - window)

        def fresh(minima: Column) -> Column:
            return F.filter(minima, lambda x, i: (i == 0) | ((x != F.get(minima, i - 1)) & (i <= full)))

        # the window goes on to a k-gram when that enters as the least, or when the one before has left
        def at(found: Column, x: Column, i: Column) -> Column:
            return F.when(i == 0, F.lit(0)).when(x < F.get(found, i - 1), pos(x) - (window - 1)).otherwise(pos(F.get(found, i - 1)) + 1)

        def result(found: Column) -> Column:
            structs = F.transform(found, lambda x, i: F.struct(
                gram(b, place(x)).alias("hash"), pos(x).alias("pos"), at(found, x, i).alias("at")))
            return F.filter(structs, lambda _, i: (s == 0) | (i > 0))

        return let(keys, lambda k: least(k, 1, lambda minima: let(fresh(minima), result)))

    wide = rows.withColumn("__b", F.encode(bare(F.col(text)), "UTF-32"))
    grams = F.greatest(F.lit(1), F.floor(F.octet_length("__b") / WIDE).cast("int") - (chars - 1))
    windows = F.greatest(F.lit(1), grams - (window - 1))
    none = F.expr("CAST(array() AS array<struct<hash:bigint,pos:int,at:int>>)")
    found = let(F.col("__b"), lambda b: let(grams, lambda n: F.flatten(F.transform(
        F.sequence(F.lit(0), F.floor((windows - 1) / segment).cast("int")), lambda s: chosen(b, n, s)))))
    return wide.withColumn(put, F.when(F.col(text).isNotNull(), F.when(F.octet_length("__b") > 0, found).otherwise(none))).drop("__b")


def placed_hashes(found: Column, by=0) -> Column:
    """Hash and position of chosen k-grams, ``by`` further on."""
    return F.transform(found, lambda x: F.struct(x["hash"].alias("hash"), (x["pos"] + by).alias("pos")))


def digest(found: Column) -> Column:
    """32 hexadecimal digits that equal fingerprints share."""
    def digits(h: Column) -> Column:
        return F.lower(F.lpad(F.hex(h), 16, "0"))

    return F.concat(digits(F.xxhash64(found)), digits(F.xxhash64(F.lit(9), found)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two arrays of distinct hashes; 1 of two empty ones."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def fingerprints(docs: DataFrame, chars: int = CHARS, window: int = CHAR_WINDOW, id_col: str = "doc_id",
                 text_col: str = "text", segment: int = SEGMENT) -> DataFrame:
    """doc_id and found, the chosen hashes with their positions, one row per row of ``docs``.

    Null and empty texts have none; repeated rows each have their own. An empty table gives no rows.
    """
    rows = id_and_text(docs, id_col, text_col)
    return with_chosen_chars(rows, "text", "found", chars, window, segment).select("doc_id", placed_hashes(F.col("found")).alias("found"))


def in_ranges(texts: DataFrame, per_range: int, folder: str) -> DataFrame:
    """``texts`` with a range number and, in each range, a copy (ghost) of the first row of the next one.

    Ranges follow doc_id; after the last comes the first. Only ids are sorted here, and one id of each range
    is broadcast, ``MOST_RANGES`` at most; rows of a range are sorted and streamed, so that larger ones spill.
    """
    ids = texts.select("doc_id")
    ranges = min(parts(texts.count(), per_range), MOST_RANGES)
    bounds = stored(ids.repartitionByRange(ranges, "doc_id").groupBy(F.spark_partition_id().alias("at"))
                    .agg(F.min(F.struct("doc_id")).alias("low")).filter("low IS NOT NULL"), f"{folder}/bounds")
    # one row: the sorted first ids of the ranges, in chunks, so that a range is found in two short searches
    lows = bounds.agg(F.array_sort(F.collect_list("low")).alias("lows"))
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("lows"))).cast("int"))
    lows = lows.withColumn("width", width).withColumn("chunks", F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size("lows") - 1) / F.col("width")).cast("int"))),
        lambda c: F.slice("lows", c * F.col("width") + 1, F.col("width"))))

    def at_most(some: Column, low) -> Column:
        return F.aggregate(some, F.lit(0), lambda n, x: n + F.when(low(x) <= F.struct("doc_id"), F.lit(1)).otherwise(F.lit(0)))

    found = texts.join(F.broadcast(lows)).withColumn("chunk", F.greatest(F.lit(1), at_most(F.col("chunks"), lambda c: F.get(c, F.lit(0)))))
    placed = found.select("doc_id", "text", "lows", (
        (F.col("chunk") - 1) * F.col("width") + F.greatest(F.lit(1), at_most(F.get("chunks", F.col("chunk") - 1), lambda x: x))
        ).alias("range"))
    first = F.get("lows", F.col("range") - 1)["doc_id"]
    before = F.when(F.col("range") > 1, F.col("range") - 1).otherwise(F.size("lows"))
    here = F.struct("range", F.lit(False).alias("ghost"))
    both = F.when(F.col("doc_id").eqNullSafe(first), F.array(here, F.struct(before.alias("range"), F.lit(True).alias("ghost"))))
    return placed.select("doc_id", "text", F.explode(F.coalesce(both, F.array(here))).alias("place")).select(
        "doc_id", "text", "place.range", "place.ghost")


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last quarter (code points, rounded down) replaced by as many of the start of ``following``."""
    n = F.char_length(text)
    quarter = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - quarter), F.substring(following, F.lit(1), quarter))


def with_next(docs: DataFrame, chars: int = CHARS, window: int = CHAR_WINDOW, id_col: str = "doc_id", text_col: str = "text",
              per_range: int = DOCS_PER_RANGE, folder: str | None = None) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document, ascending doc_id.

    doc_id, n_chars, edited_text, found, edited_found (chosen hashes with positions) and the likenesses
    near_edited and near_next. Rows that share a doc_id follow by a hash of the text; a null doc_id is
    the smallest; a single document is its own next one. An empty table gives no rows.
    """
    folder = folder or workspace(docs.sparkSession, "fingerprints")
    placed = in_ranges(id_and_text(docs, id_col, text_col), per_range, folder)
    order = Window.partitionBy("range").orderBy("ghost", "doc_id", "tie")
    # texts are dealt and sorted before they are hashed, so that the shuffle carries texts alone
    followed = placed.withColumn("tie", F.xxhash64("text")).withColumn("next_text", F.lead("text").over(order))
    own = with_chosen_chars(followed, "text", "found", chars, window)
    joined = own.withColumn("next_found", F.lead("found").over(order)).filter(~F.col("ghost"))
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    halves = joined.select(
        "doc_id", n.alias("n_chars"), "found", "next_found",
        edited(F.col("text"), F.col("next_text")).alias("edited_text"), bare(F.substring(F.col("text"), F.lit(1), n - quarter)).alias("__a"),
        bare(F.substring(F.col("next_text"), F.lit(1), quarter)).alias("__b"))
    # windows that lie within either part of an edited text have chosen what they chose in its own text, so that only
    # those across the seam are looked at
    reach = chars + window - 1
    a, b = F.char_length("__a"), F.char_length("__b")
    long = halves.withColumns({"na": a, "nb": b, "long": (a >= reach) & (b >= reach)})
    seam = long.withColumn("seam", F.when(F.col("long"), F.concat(
        F.substring(F.col("__a"), F.col("na") - (reach - 2), F.lit(reach - 1)), F.substring(F.col("__b"), F.lit(1), F.lit(reach - 1))
        )).otherwise(F.concat("__a", "__b"))).drop("__a", "__b")
    chosen = with_chosen_chars(seam, "seam", "across", chars, window)
    parts_of = chosen.withColumn("__all", F.concat(
        placed_hashes(F.filter("found", lambda x: F.col("long") & (x["at"] <= F.col("na") - reach))),
        placed_hashes(F.col("across"), F.when(F.col("long"), F.col("na") - (reach - 1)).otherwise(0)),
        placed_hashes(F.filter("next_found", lambda x: F.col("long") & (x["at"] <= F.col("nb") - reach)), F.col("na"))))
    both = parts_of.withColumn("edited_found", F.filter(
        "__all", lambda x, i: (i == 0) | (x["pos"] != F.get("__all", i - 1)["pos"])))
    paired = both.withColumns({"own": F.array_distinct(F.col("found.hash")), "changed": F.array_distinct(F.col("edited_found.hash")),
                               "next": F.array_distinct(F.col("next_found.hash"))})
    return paired.select("doc_id", "n_chars", "edited_text", placed_hashes(F.col("found")).alias("found"), "edited_found",
                         likeness(F.col("own"), F.col("changed")).alias("near_edited"),
                         likeness(F.col("own"), F.col("next")).alias("near_next"))
