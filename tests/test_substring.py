"""The substring index gives the rows of the scan, and narrows what is read."""

import random

import pytest
from pyspark.sql import functions as F

from spanstore.plans.query import contains
from spanstore.plans.substring import SubstringIndex, grams_of, needle_grams

TEXTS = ["Licensed under", "license", "", None, "ab", "aBc", "ÄÖÜ ß İı", "a\U0001f600b\U0001f600c", "100% sure_thing", "aaa aaaa", "line\nbreak", "LICENSED  UNDER", "x" * 5000 + "needle"]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice("abcdeAB é") for _ in range(rng.randrange(60))) for _ in range(400)]
    units = spark.createDataFrame([(f"u{i}", t) for i, t in enumerate(texts)], "id string, text string")
    index = SubstringIndex(spark, str(tmp_path_factory.mktemp("grams")))
    index.add(units.filter("id < \'u3\'"))
    index.add(units.filter("id >= \'u3\'"))
    index.add(units.filter("id = \'u5\'"))  # again, as after a failed run
    return units, index


def ids(rows):
    return sorted(r["id"] for r in rows.select("id").collect())


@pytest.mark.parametrize(
    "needle",
    ["license", "LICENSED", "licens_d un", "ed%under", "abc", "aBcD", "ab", "", "%", "öü", "ÄÖÜ", "ß İ", "b\U0001f600c", "aaaa", "zzz", "line\nb", "0% sure", "needle", "xxxneedle", "e é", "a_b%c", "cab%bac", "é a"],
)
def test_same_rows_as_the_scan(indexed, needle):
    units, index = indexed
    assert ids(index.matching(units, needle)) == ids(units.filter(contains(F.col("text"), needle)))


def test_rare_pieces_are_looked_up_and_common_ones_scanned(indexed):
    units, index = indexed
    assert index.plan("ab") is None and index.plan("a%b_c") is None
    assert index.plan("licensed under") and len(index.plan("licensed under")) == 6
    assert index.candidates(index.plan("licensed under")).count() <= 2
    assert index.plan("zzz") == ["zzz"] and index.candidates(["zzz"]).count() == 0
    filters = index.candidates(["abc"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in filters and "EqualTo(gram,abc)" in filters


def test_grams_are_code_points(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS if t is not None], "t string")
    for text, got in df.select("t", grams_of(F.col("t"))).collect():
        assert sorted(set(got)) == needle_grams(text.replace("%", "\0").replace("_", "\0")) or "%" in text
    assert needle_grams("Ab%cde_fgHi") == ["cde", "fgh", "ghi"]


def test_a_block_gives_one_row_for_each_piece(monkeypatch):
    import numpy as np

    from spanstore.plans import substring

    keys = np.arange(10, 10 + len(TEXTS))
    texts = [t or "" for t in TEXTS] + [chr(c) * 4 + "\0\0\0" for c in range(0x4E00, 0x4E40)]
    keys = np.arange(10, 10 + len(texts))
    wanted = {"": set(keys.tolist())}
    for key, text in zip(keys.tolist(), texts):
        for gram in needle_grams(text.replace("%", "\x01").replace("_", "\x02")):
            wanted.setdefault(gram.replace("\x01", "%").replace("\x02", "_"), set()).add(key)
    (rows,) = (b.to_pylist() for b in substring.block_postings(texts, keys))
    assert {r["gram"]: set(r["units"]) for r in rows} == wanted and len(rows) == len(wanted)
    assert all(r["n"] == len(r["units"]) == len(set(r["units"])) for r in rows)
    # Blocks of a few letters, and texts with more different letters than one number holds, give the same.
    monkeypatch.setattr(substring, "BLOCK_LETTERS", 5)
    import pyarrow as pa

    cut = substring._cut(iter([pa.RecordBatch.from_arrays([pa.array(keys), pa.array([t.encode() for t in texts], pa.binary())], ["unit", "text"])]))
    got = {}
    for r in (r for b in cut for r in b.to_pylist()):
        got.setdefault(r["gram"], set()).update(r["units"])
    assert got == wanted
    wide = ["".join(map(chr, range(0x10000, 0xF0000))), *["abc"] * 15]
    assert len(list(substring.block_postings(wide, np.arange(16)))) > 1


def test_texts_are_tested_behind_the_lookup(indexed):
    units, index = indexed
    plan = index.matching(units, "licensed under")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert len(joins) == 1 and "licensed under" in joins[0] and plan.count("licensed under") == 1
