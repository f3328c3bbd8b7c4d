"""Secret scans (operator 9), in DataFrame and SQL functions only.

Three fixed patterns give the base spans. Two character Markov models, of
random strings and of ordinary identifiers, add spans: a token of key
characters is a secret when its log-likelihood ratio a pair of characters
passes a threshold. Both models are trained here, from tokens that the base
patterns label: what a pattern has found is random, all other tokens, with
digits and slashes or without, are ordinary. As secrets that no pattern finds
are among those, a pair counts once less there than it is seen.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import id_and_text, text_or_empty

# fixed values: kinds, patterns and least lengths
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
# a run of 16 or more: what leftmost matching of all runs leaves once shorter ones are dropped
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_CHARS, ACCESS_CHARS = 12, 18

#: Tokens the models judge, tokens they learn from, and the characters of both.
JUDGED, LEARNT = "[A-Za-z0-9+/_=-]{16,}", "[A-Za-z0-9+/_-]{8,}"
KEYWORD = "(?i)^(password|passwd|secret|token|api_?key)$"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
#: Documents to learn from, at most about; log-likelihood ratio a pair of characters from which a token is a secret; added
#: count of each pair; what an ordinary pair's count is less than seen; most that one pair speaks for a secret.
TRAIN_DOCS, LEAST_RATIO, ADDED, ONCE, MOST = 20_000, 0.4, 1.0, 1, 2.0

#: A private-use character that marks matches, and the one that stands for it where a text has it itself.
MARK, MARK_IN_TEXT = "\ue000", "\ue001"
SPAN = "array<struct<start:int,kind:int,end:int>>"
#: Spans of a kind that are looked through one by one, the bits of the number of spans a text can have, and characters of a chunk.
FEW, SPAN_BITS, CHUNK = 16, 27, 4096


def pieces(text: Column, pattern: str) -> Column:
    """``text`` parted around the leftmost matches of ``pattern`` that do not overlap: every second piece is a match."""
    return F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK)


#: Pieces that one accumulator walks; their starts come from sums of pieces, blocks and runs of blocks.
BLOCK = 64


def _block_sums(values: Column) -> Column:
    """The sum of each block of an array of numbers."""
    def one(k: Column) -> Column:
        last = F.least(F.size(values), (k + 1) * BLOCK) - 1
        return F.aggregate(F.sequence(k * BLOCK, last), F.lit(0), lambda total, j: total + F.get(values, j))

    return F.transform(_blocks(values), one)


def _blocks(values: Column) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")))


def with_spans(rows: DataFrame, parted: dict[str, tuple[int, Callable[[Column], Column] | None]], texts: bool = False) -> DataFrame:
    """``rows`` with the columns named in ``parted``, arrays of pieces, replaced by the spans of their matches.

    Each has the number of its kind and what has to hold of a match. A span has start (code points), kind and end, and with
    ``texts`` the match. The time is linear in the length of a text: a piece's start is the sum of a few block sums, no
    array grows by more than a block, and no text is cut by an offset from its start.
    """
    names = list(parted)
    # each step is a column of its own, so that it is worked out once; a text without a match has one piece
    found = rows.withColumns({f"__n_{c}": F.transform(c, lambda piece: F.char_length(piece)) for c in names})
    found = found.withColumns({f"__s_{c}": _block_sums(F.col(f"__n_{c}")) for c in names})
    found = found.withColumns({f"__t_{c}": _block_sums(F.col(f"__s_{c}")) for c in names})
    kind_of = SPAN if not texts else SPAN.replace(">>", ",token:string>>")

    def of(c: str) -> Column:
        none = F.expr(f"CAST(array() AS {kind_of})")
        # as a variable of a function the sums are worked out once, whatever the optimizer makes of the columns
        sums = F.array(F.struct(F.col(f"__n_{c}").alias("n"), F.col(f"__s_{c}").alias("s"), F.col(f"__t_{c}").alias("t")))
        return F.when(F.size(c) > 1, F.get(F.transform(sums, lambda v: found_in(c, none, v["n"], v["s"], v["t"])), F.lit(0))).otherwise(none)

    def found_in(c: str, none: Column, lengths: Column, sums: Column, runs: Column) -> Column:
        kind, holds = parted[c]

        def base(k: Column) -> Column:
            run = F.floor(k / BLOCK).cast("int")
            before = F.when(run > 0, F.aggregate(F.sequence(F.lit(0), run - 1), F.lit(0), lambda t, j: t + F.get(runs, j))).otherwise(0)
            inside = F.when(k % BLOCK > 0, F.aggregate(F.sequence(run * BLOCK, k - 1), F.lit(0), lambda t, j: t + F.get(sums, j))).otherwise(0)
            return before + inside

        def step(state: Column, j: Column) -> Column:
            piece, end = F.get(c, j), state["at"] + F.get(lengths, j)
            own = [state["at"].alias("start"), F.lit(kind).alias("kind"), end.alias("end")] + ([piece.alias("token")] if texts else [])
            wanted = (j % 2 == 1) if holds is None else (j % 2 == 1) & holds(piece)
            return F.struct(end.alias("at"), F.when(wanted, F.concat(state["found"], F.array(F.struct(*own)))).otherwise(state["found"]).alias("found"))

        def block(k: Column) -> Column:
            last = F.least(F.size(lengths), (k + 1) * BLOCK) - 1
            return F.aggregate(F.sequence(k * BLOCK, last), F.struct(base(k).alias("at"), none.alias("found")), step)["found"]

        return F.flatten(F.transform(_blocks(lengths), block))

    return found.withColumns({c: of(c) for c in names}).drop(*(f"__{x}_{c}" for c in names for x in "nst"))


def with_base_spans(texts: DataFrame) -> DataFrame:
    """``texts`` (with a column text) with columns clean, and assign, access and hex: the arrays of base spans."""
    # each step is a column of its own, so that no pattern is run twice
    clean = texts.withColumn("clean", F.replace(F.col("text"), F.lit(MARK), F.lit(MARK_IN_TEXT)))
    parted = clean.select("*", pieces(F.col("clean"), ASSIGN).alias("assign"), pieces(F.col("clean"), ACCESS).alias("access"),
                          pieces(F.col("clean"), HEX).alias("hex"))
    return with_spans(parted, {
        "assign": (0, lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_CHARS),
        "access": (1, lambda m: F.char_length(m) >= ACCESS_CHARS), "hex": (2, None)})


def before(spans_of: Column, at: Column, field: str = "start") -> Column:
    """How many of the ascending spans have ``field`` below ``at``, by halving."""
    steps = F.lit(np.array([1 << b for b in range(SPAN_BITS, -1, -1)], np.int32))
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(
        (n + step <= F.size(spans_of)) & (F.get(spans_of, n + step - 1)[field] < at), n + step).otherwise(n))


def overlaps(a: Column, spans_of: Column) -> Column:
    """Whether span ``a`` shares a place with one of the ascending spans of one kind, which do not overlap each other."""
    few = F.exists(spans_of, lambda b: (b["start"] < a["end"]) & (a["start"] < b["end"]))
    last = F.array(F.get(spans_of, F.greatest(F.lit(0), before(spans_of, a["end"]) - 1)))
    return F.when(F.size(spans_of) <= FEW, few).otherwise(F.exists(last, lambda b: (b["start"] < a["end"]) & (a["start"] < b["end"])))


def touches_base(a: Column) -> Column:
    return overlaps(a, F.col("assign")) | overlaps(a, F.col("access")) | overlaps(a, F.col("hex"))


def labelled_tokens(docs: DataFrame, train_docs: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """token and random (boolean) of a bounded sample: documents by a hash of their id, about ``train_docs`` at most."""
    share = min(1.0, train_docs / max(1, docs.count()))
    chosen = id_and_text(docs, id_col, text_col).filter(
        F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(math.ceil(share * (1 << 20))))
    base = with_base_spans(chosen.select("text")).select("assign", "access", "hex", pieces(F.col("clean"), LEARNT).alias("learnt"))
    found = with_spans(base, {"learnt": (3, None)}, texts=True)
    marked = found.select(F.explode(F.transform("learnt", lambda t: F.struct(t["token"].alias("token"), touches_base(t).alias("random")))).alias("t"))
    return marked.select("t.token", "t.random").filter(~F.col("random") | ~F.col("token").rlike(KEYWORD))


def pair_ratios(tokens: DataFrame) -> list[float]:
    """log P(random) - log P(ordinary) of each pair of characters in :data:`ALPHABET`, row by row: a table of fixed size.

    At most :data:`MOST`, so that a few pairs that were never seen do not outweigh the rest of a token. Without examples of a label its model is uniform.
    """
    n = len(ALPHABET)
    pairs = tokens.select("random", F.explode(F.sequence(F.lit(1), F.char_length("token") - 1)).alias("i"), "token").select(
        "random", F.expr("substring(token, i, 2)").alias("pair"))
    counts = {True: [[ADDED] * n for _ in range(n)], False: [[ADDED] * n for _ in range(n)]}
    # at most 2 * 68 * 68 rows, whatever the corpus
    for r in pairs.groupBy("random", "pair").count().collect():
        if all(c in ALPHABET for c in r["pair"]):
            counts[r["random"]][ALPHABET.index(r["pair"][0])][ALPHABET.index(r["pair"][1])] += (
                r["count"] if r["random"] else max(r["count"] - ONCE, 0))
    return [min(MOST, math.log(counts[True][a][b] / sum(counts[True][a])) - math.log(counts[False][a][b] / sum(counts[False][a])))
            for a in range(n) for b in range(n)]


def ratio(token: Column, table: list[float]) -> Column:
    """The log-likelihood ratio of a token, a pair of its characters."""
    # one literal, not one for each number
    scores, places = F.lit(np.array(table, np.float64)), F.lit(np.array(_places(), np.int32))

    def place(at: Column) -> Column:
        return F.get(places, F.ascii(F.substring(token, at, F.lit(1))))

    pairs = F.sequence(F.lit(1), F.char_length(token) - 1)
    return F.aggregate(pairs, F.lit(0.0), lambda total, i: total + F.get(
        scores, place(i) * len(ALPHABET) + place(i + 1))) / (F.char_length(token) - 1)


def _places() -> list[int]:
    """The place of each ASCII character in :data:`ALPHABET`; -1 of others."""
    return [ALPHABET.find(chr(c)) for c in range(128)]


def find_secrets(docs: DataFrame, table: list[float], least_ratio: float = LEAST_RATIO) -> DataFrame:
    """``docs`` (with a column text) and the arrays assign, access, hex and markov.

    markov has the tokens of ``JUDGED`` characters whose ratio reaches ``least_ratio`` and that no base span touches.
    """
    base = with_base_spans(docs)
    own = [c for c in base.columns if c != "clean"]
    judged = with_spans(base.select(*own, pieces(F.col("clean"), JUDGED).alias("judged")), {"judged": (3, None)}, texts=True)
    free = judged.withColumn("judged", F.filter("judged", lambda t: ~touches_base(t)))
    random = F.filter("judged", lambda t: ratio(t["token"], table) >= least_ratio)
    return free.select(*own, F.transform(random, lambda t: t.dropFields("token")).alias("markov"))


def listed(found: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(F.array_sort(found), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS,
         least_ratio: float = LEAST_RATIO) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base and spans (lists of kind:start:end), n_markov, one row per row of ``docs``.

    Positions are code points of the text as it is, ends exclusive; null and empty texts have no spans, and the time
    is linear in the length of a text. Repeated rows are scanned each. An empty table gives no rows.
    """
    table = pair_ratios(labelled_tokens(docs, train_docs, id_col, text_col))
    found = find_secrets(id_and_text(docs, id_col, text_col), table, least_ratio)
    return found.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        listed(F.concat("assign", "access", "hex")).alias("base"), listed(F.concat("assign", "access", "hex", "markov")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars",
           put: str = "[SECRET]", train_docs: int = TRAIN_DOCS, least_ratio: float = LEAST_RATIO) -> DataFrame:
    """``docs`` with every span replaced by ``put``; overlapping spans count as one.

    No row goes. A column ``chars_col`` follows the text where that changes; null texts stay null.
    """
    table = pair_ratios(labelled_tokens(docs, train_docs, id_col, text_col))
    rows = docs.select(F.struct("*").alias("doc"), text_or_empty(text_col).alias("text"))
    found = find_secrets(rows, table, least_ratio)
    kinds = [F.col(k) for k in KINDS]
    found = found.withColumn("spans", F.array_sort(F.concat(*kinds)))
    some = F.size("spans") > 0
    # cut once, from the start, so that a part of the text is found without a walk
    found = found.withColumn("chunks", F.when(some, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))))
    chunks = F.col("chunks")

    def part(lo: Column, hi: Column) -> Column:
        a, b = F.floor(lo / CHUNK).cast("int"), F.floor((hi - 1) / CHUNK).cast("int")
        inner = F.when(b > a + 1, F.array_join(F.transform(F.sequence(a + 1, b - 1), lambda k: F.get(chunks, k)), "")).otherwise("")
        return F.when(hi <= lo, F.lit("")).when(a == b, F.substring(F.get(chunks, a), lo - a * CHUNK + 1, hi - lo)).otherwise(
            F.concat(F.substring(F.get(chunks, a), lo - a * CHUNK + 1, F.lit(CHUNK)), inner, F.substring(F.get(chunks, b), F.lit(1), hi - b * CHUNK)))

    def covered(start: Column, kind: Column) -> Column:
        """Where the spans before this one end: of each kind, which has no overlaps, the last one counts."""
        ends = []
        for k, spans_of in enumerate(kinds):
            # of spans that start alike, those of lower kinds come first
            n = F.when(F.lit(k) < kind, before(spans_of, start + 1)).otherwise(before(spans_of, start))
            ends.append(F.when(n > 0, F.get(spans_of, n - 1)["end"]).otherwise(0))
        return F.greatest(*ends)

    def replaced(s: Column) -> Column:
        at = covered(s["start"], s["kind"])
        return F.when(s["start"] >= at, F.concat(part(at, s["start"]), F.lit(put))).otherwise("")

    whole = F.greatest(*(F.when(F.size(k) > 0, F.element_at(k, -1)["end"]).otherwise(0) for k in kinds))
    length = (F.size("chunks") - 1) * CHUNK + F.char_length(F.element_at("chunks", -1))
    changed = found.select("doc", F.when(some, F.concat(F.array_join(F.transform("spans", replaced), ""), part(whole, length))).alias("text"))
    columns = []
    for name, kind in docs.dtypes:
        own = F.col("doc")[name]
        if name == text_col:
            own = F.coalesce("text", own)
        elif name == chars_col:
            own = F.coalesce(F.char_length("text").cast(kind), own)
        columns.append(own.alias(name))
    return changed.select(*columns)
