"""The Merkle manifest against a plain fold of lists."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from funnelguard.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, i):
    found = []
    for row in levels[:-1]:
        found.append((i % 2, row[i ^ 1] if i ^ 1 < len(row) else None))
        i //= 2
    return found


def expected(rows):
    """doc_id, leaf, subroot, root, proof, folded root and verified of rows in the order of SCHEMA."""
    def leaf(r, n):
        return H(field(r[0]), field(r[3]), field(r[2]), field(n), field(r[1]))

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(r, r[4]), r))
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: tree([x[2] for x in sorted(groups[k], key=lambda x: x[:3])]) for k in names}
    top = tree([trees[k][-1][0] for k in names])
    out = []
    for g, k in enumerate(names):
        for i, (known, _, own, r) in enumerate(sorted(groups[k], key=lambda x: x[:3])):
            steps = path(trees[k], i) + path(top, g)
            node = own
            if known and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                node = leaf(r, None if r[4] is None else r[4] + 1)
            for digit, other in steps:
                node = H(node) if other is None else H(other, node) if digit else H(node, other)
            out.append((r[0], own, trees[k][-1][0], top[-1][0], H(*[s for _, s in steps if s]), node, node == top[-1][0]))
    return Counter(out)


def check(spark, rows, levels=3):
    df = spark.createDataFrame(rows, SCHEMA)
    assert Counter(map(tuple, merkle.manifest(df, levels=levels).collect())) == expected(rows)


@pytest.mark.parametrize("levels", [1, 3, 10])
def test_manifest_of_uneven_groups(spark, levels):
    # one group with a third of all rows, groups of one, two and 2^k + 1 rows
    sizes = {"en": 41, "de": 17, "fr": 9, "x": 1, "y": 2, "": 3, "é": 5, None: 6}
    rows = [(100 * g + i, f"text {g} {i}", lang, f"s{i % 3}", 7 * i) for g, (lang, n) in enumerate(sizes.items()) for i in range(n)]
    check(spark, rows, levels)


def test_manifest_of_nulls_ties_repeated_and_long_rows(spark):
    rows = [(None, None, None, None, None), (None, "a", "en", "s", 1), (5, "é🙂", "en", None, 2), (5, "é🙂", "en", None, 2),
            (5, "other", "en", None, None), (6, "", "en", "", 2 ** 63 - 1), (7, "x" * 3_000_000, "de", "s", 3_000_000)]
    rows += [(9, "same", "es", "s", 4)] * 40  # whole pages that are equal
    rows += [(-i, "n", "pt", "s", -i) for i in range(20)]
    check(spark, rows)


def test_manifest_of_one_row_and_of_none(spark):
    check(spark, [(1, "only", "en", "s", 4)])
    empty = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and "verified" in empty.columns


def test_manifest_with_other_columns(spark):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'q' AS g", "1 AS rank", "2 AS n", "'d' AS digest", "'l' AS leaf", "3 AS page", "x'00' AS forged")
    assert Counter(map(tuple, merkle.manifest(df, levels=2).collect())) == expected(rows)


def test_records_are_content_addressed_and_a_false_leaf_is_found(spark, tmp_path):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(13)]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    built = merkle.build(merkle.leaves(df, "doc_id", "lang", ["doc_id", "text"], {}, F.lit(False)), str(tmp_path / "m"), 2)
    records = [r for t in built.groups.tiers for p in t.collect() for r in p.records]
    assert all(bytes(r.digest) == merkle.parent([bytes(c) for c in r.children]) for r in records)
    assert len(records) == 7 + 4 + 2 + 1
    wrong = merkle.proofs(built).withColumn("forged", F.when(F.col("doc_id") == 4, F.unhex(F.sha2(F.lit("false"), 256))))
    found = {r.doc_id: r.folded == r.root for r in merkle.verify(built, wrong).collect()}
    assert found == {i: i != 4 for i in range(13)}
