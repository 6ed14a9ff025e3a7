"""Quality rules and mixing: SQL on the small tables, edge rows, brute force."""

from collections import Counter

import pytest

from tests.oracle import compare, connect
from tillhouse.llm import mixing, quality
from tillhouse.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, source string, n_words int, kept string"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, db, name):
    assert compare(spark, db, SF, QUERIES[name], SQL[name]) is None


def _rows(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, "x") for i, t, s in rows], SCHEMA)


def test_metrics_of_edge_rows(spark):
    text = "a b c d e\na b c d e\n\n x \n# %"
    rows = _rows(spark, [(1, None, None), (2, "", "s"), (3, text, "s"), (None, text, "s"), (4, " \t\n", "s")])
    got = {r.doc_id: r for r in quality.quality_rules(rows).collect()}
    assert len(got) == 5
    for empty in (1, 2, 4):
        assert (got[empty].n_words, got[empty].n_dup_lines, got[empty].base_failed, got[empty].kept) == (0, 0, True, False)
    r = got[3]
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (13, 13, 2, 1, 10, True)
    assert got[None].n_repeat_words == 10


def _own(k: int) -> str:
    name = "".join(chr(97 + int(c)) for c in str(k))  # digits would be alike
    return " ".join(f"{name}x{chr(97 + j)}" for j in range(20))


def test_boilerplate_is_counted_by_host_and_distinct_text(spark):
    line = "All Rights 2021  reserved by them and more of it in this long line"
    rows = [(k, f"{line}\n{_own(k)}", "a") for k in range(30)]  # one line is boilerplate, most words are left
    rows += [(100 + k, f"{line.upper()}\nonly{chr(97 + k)}", "a") for k in range(5)]  # little is left
    rows += [(200 + k, _own(999), "b") for k in range(40)]  # copies count once
    rows += [(300 + k, f"{line}\n{_own(300 + k)}", "c") for k in range(5)]  # not often enough there
    docs = _rows(spark, rows)
    got = {r.doc_id: (r.kept, r.words_left) for r in quality.quality_rules(docs).collect()}
    assert all(got[k] == (True, 20) for k in range(30))
    assert all(got[100 + k] == (False, 1) for k in range(5))
    assert all(got[200 + k] == (True, 20) for k in range(40))
    assert all(got[300 + k] == (True, 34) for k in range(5))
    clean = {r.doc_id: r.clean_text for r in quality.without_boilerplate(docs).collect()}
    assert clean[3] == _own(3) and clean[300].startswith(line) and clean[201] == _own(999)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, v in got.items() if v[0])


def test_empty_tables(spark):
    none = _rows(spark, [(1, "a", "s")]).filter("doc_id = 2")
    assert quality.quality_rules(none).count() == 0
    assert quality.keep_good(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert mixing.mixed_rows(none).count() == 0


def test_mix(spark, folder):
    rows = [(k, " ".join(["w"] * (1 + k % 50)), ["a", "b", "c", None][k % 4]) for k in range(2000)] + [(5000, None, "a"), (5000, None, "a")]
    path = folder()
    _rows(spark, rows).write.parquet(path)
    docs = spark.read.parquet(path)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert r.taken <= 2 * r.size and r.taken == r.copies * r.size
        by.setdefault((r.source, r.source_size, r.target), []).append(r.taken)
    total = sum(s for _, s, _ in by)
    assert sum(t for _, _, t in by) == pytest.approx(1.5 * total)
    for (_, size, target), taken in by.items():
        assert target <= 2 * size and abs(sum(taken) - target) <= 25
    again = mixing.mix(docs).collect()
    assert sorted((r.doc_id, r.copies) for r in got) == sorted((r.doc_id, r.copies) for r in again)
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    copies = Counter(r.doc_id for r in mixed.collect())
    assert copies == Counter({r.doc_id: r.copies for r in got if r.copies and r.doc_id != 5000}) + Counter(
        {5000: sum(r.copies for r in got if r.doc_id == 5000)})


def test_buckets_cut_like_one_sorted_source(spark, monkeypatch):
    rows = _rows(spark, [(k, " ".join(["w"] * (1 + k % 7)), "ab"[k % 2]) for k in range(3000)])
    whole = {r.doc_id: r.copies for r in mixing.mix(rows).collect()}
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 50)
    assert {r.doc_id: r.copies for r in mixing.mix(rows).collect()} == whole


def test_repeated_ids_are_drawn_one_by_one(spark):
    """A third of a source under one id, or under none: its target is met all the same."""
    for repeated in (7, None):
        ids = [repeated if k % 3 == 0 else 10_000 + k for k in range(6000)]
        rows = _rows(spark, [(i, " ".join(["word"] * 100), "a") for i in ids] + [(k, " ".join(["w"] * 50), "b") for k in range(20_000, 26_000)])
        for layout in (rows.repartition(1), rows.repartition(9)):
            got = mixing.mix(layout, weights=(1.25, 1.75)).collect()
            assert len(got) == 12_000
            for source in "ab":
                own = [r for r in got if r.source == source]
                assert abs(sum(r.taken for r in own) - own[0].target) <= 100
            taken = sorted(r.taken for r in got if r.doc_id == repeated)
            assert repeated is None or (taken[0], taken[-1]) == (100, 200) or taken[0] == 0 and taken[-1] == 100
        assert sorted(map(str, got)) == sorted(map(str, mixing.mix(rows.repartition(4), weights=(1.25, 1.75)).collect()))


def test_boilerplate_of_a_hot_host(spark):
    """Documents that are little but a line of 60 documents go, also in a host of thousands."""
    footer = "All of this is ours and you may not copy it without our leave"
    rows = [(k, _own(k), "hot") for k in range(3000)] + [(5000 + k, f"{footer}\n{footer}\nnumber word{k}", "hot") for k in range(60)]
    rows += [(6000 + k, f"{_own(6000 + k)}\n{footer}", "hot") for k in range(5)] + [(7000, "word " + footer + " and " * 9, "other"), (8000, _own(1) * 4000, "long")]
    got = {r.doc_id: r.kept for r in quality.quality_rules(_rows(spark, rows)).collect()}
    base = {r.doc_id: r.base_failed for r in quality.quality_rules(_rows(spark, rows)).collect()}
    assert not any(got[5000 + k] for k in range(60)) and all(got[k] for k in range(3000)) and all(got[6000 + k] for k in range(5))
    assert sorted(r.doc_id for r in quality.keep_good(_rows(spark, rows)).collect()) == sorted(k for k, v in got.items() if v)
    assert base[8000] and not got[8000]
