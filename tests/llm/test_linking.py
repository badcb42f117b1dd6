"""Hot buckets: rows grow with their members, no link is lost; one row of each group of near copies stays."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from airgrain.llm import jaccard, lines, linking


def of_one_bucket(spark, texts_of, monkeypatch, percent=90):
    """Components of items that share one bucket, and the rows that were compared."""
    rows, compared = [(i, t) for i, t in enumerate(texts_of)], []
    frame = spark.createDataFrame(rows, "id long, text string")
    buckets = frame.select(F.lit(1).cast("long").alias("key"), "id", F.size(F.split("text", " ")).alias("n"))
    plain = linking._compared
    monkeypatch.setattr(linking, "_compared", lambda parts, *rest: (compared.append(parts.count()), plain(parts, *rest))[1])
    grams = lambda t: jaccard.shingle_sets(t, 1)
    found = linking.linked_components(
        buckets, lambda parts: frame.join(parts, "id"), grams, lambda ids, sets, probe: jaccard.tree_links(ids, sets, probe, percent), percent / 100, grams=grams, percent=percent)
    return {r.id: r.component for r in found.collect()}, compared


def test_rows_grow_with_the_members_of_a_bucket(spark, monkeypatch):
    common = " ".join(f"c{i}" for i in range(30))
    sizes = {}
    for members in (512, 4096):
        monkeypatch.undo()
        found, compared = of_one_bucket(spark, [f"{common} a{i} b{i} c{i}x d{i} e{i}" for i in range(members)], monkeypatch)
        assert not found
        sizes[members] = sum(compared)
    assert sizes[4096] <= 8.5 * sizes[512]


def test_links_between_members_outside_the_largest_component(spark, monkeypatch):
    # A large component, many members of their own, and pairs among them and with the large one that only a second look finds.
    rng, common = random.Random(1), [f"c{i}" for i in range(30)]
    texts = [" ".join([*common, f"x{i}"]) for i in range(300)]
    texts += [" ".join([*common, *(f"o{i}.{k}" for k in range(12))]) for i in range(300)]
    texts += [t + " more" for t in rng.sample(texts[300:], 60)]
    sets = [set(t.split()) for t in texts]
    top = list(range(len(texts)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                top[max(a, b)] = min(a, b)
    want = [root(i) for i in range(len(sets))]
    monkeypatch.setattr(linking, "CHUNKS", 1)
    found, _ = of_one_bucket(spark, texts, monkeypatch)
    assert [found.get(i, i) for i in range(len(texts))] == want and len(set(want)) == 301


def test_lines_with_a_common_head(spark, monkeypatch):
    """Lines that share 85 of 115 characters link only where the rest is alike too."""
    monkeypatch.setattr(linking, "CHUNKS", 1)
    rng = random.Random(2)
    tail = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(30))
    head = "this text stands at the head of very many lines of the corpus and is the same in all.. "
    body = [head + tail() for _ in range(700)]
    body += [b[:-1] + "#" for b in body[:80]]
    got = {(r.doc_id): r for r in lines.line_classes(spark.createDataFrame(list(enumerate(body)), "doc_id long, text string")).collect()}
    for i in range(80):
        assert got[i].class_id == got[700 + i].class_id and got[i].kept and not got[700 + i].kept
    assert sum(not r.kept for r in got.values()) == 80


def test_run_hashes_tell_runs_apart():
    for line in ("", "abc", "abcdefg", "abababababab", "héllo wörld 中文字"):
        runs = {line[i:i + 7] for i in range(max(1, len(line) - 6))}
        got = lines.run_hashes([line])[0]
        assert len(got) == len(runs) and (np.sort(got) == got).all()


@pytest.mark.parametrize("extra", ["_row", "_r", "o", "component", "doc"])
def test_one_row_of_each_group_stays(spark, extra):
    text, other = " ".join(f"w{i}" for i in range(50)), " ".join(f"v{i}" for i in range(50))
    rows = [(1, text, 5), (1, text, 6), (2, text, 7), (None, text, 8), (None, text, 9), (3, other, 1), (None, None, 2), (None, "", 3), (None, "", 4), (4, other + " end", 1), (None, "one two", 1), (5, "one two", 1)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, `{extra}` int")
    left = jaccard.jaccard_stage(spark, docs, "")
    assert left.columns == docs.columns
    got = [tuple(r) for r in left.collect()]
    assert sorted(r[0] for r in got if r[1] == text) == [1] and [r[0] for r in got if (r[1] or "").startswith("v0")] == [3]
    assert len(got) == 6 and {r[0] for r in got if r[1] == "one two"} == {5}
    assert jaccard.jaccard_stage(spark, docs.where("false"), "").count() == 0


@pytest.mark.parametrize("extra", ["_row", "_away", "kept", "line_no", "ROW"])
def test_line_removal_keeps_extra_columns(spark, extra):
    docs = spark.createDataFrame([(1, "A line\nB line", 7), (2, "A line\nC line", 8), (None, None, 9)], f"doc_id long, text string, `{extra}` int")
    out = lines.without_repeated_lines(docs)
    assert out.columns == docs.columns and sorted(map(tuple, out.collect()), key=str) == sorted([(1, "A line\nB line", 7), (2, "C line", 8), (None, None, 9)], key=str)


def test_texts_of_one_id_are_groups_of_their_own(spark):
    text = lambda k, *end: " ".join([f"{k}{i}" for i in range(40)] + list(end))
    rows = [(1, text("a")), (1, text("b")), (2, text("a", "x")), (3, text("b", "y")), (1, text("b")), (None, text("c")), (None, text("d"))]
    left = jaccard.jaccard_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted((str(r.doc_id), r.text[0]) for r in left.collect()) == [("1", "a"), ("1", "b"), ("None", "c"), ("None", "d")]
