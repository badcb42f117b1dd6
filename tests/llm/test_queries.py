"""Registered queries and the pipeline, every contract column against plain Python."""

import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from airgrain.llm import language_model, queries, quality

GOOD = ["river", "stone", "light", "paper", "garden", "winter", "music", "letter", "window", "bread", "silver", "forest"]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def prose(rng, n):
    return " ".join(rng.choice(GOOD) + str(rng.randint(0, 99)) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def corpus():
    """Good and bad documents, near and exact copies, benchmark passages, repeated rows, nulls, a hot source."""
    rng = random.Random(8)
    rows = [(i, "\n".join(prose(rng, rng.randint(20, 40)) for _ in range(1 + i % 3)), "hot" if i % 3 else f"s{i % 7}") for i in range(90)]
    rows += [(100 + i, "BUY!! NOW!! $$$ CHEAP!! " * (3 + i % 4), "hot") for i in range(30)]
    rows += [(200 + i, rows[i][1], "copy") for i in range(10)] + [(220 + i, rows[10 + i][1] + " end", None) for i in range(10)]
    bench = [(i, prose(rng, 30)) for i in range(4)]
    rows += [(240 + i, bench[i][1] + " " + prose(rng, 10), "s1") for i in range(4)]
    rows += [(300, None, "s1"), (301, "", None), (302, " \n ", "s1"), rows[3], rows[3], (None, rows[5][1], "s2"), (None, prose(rng, 25), None)]
    return rows, bench


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    at = tmp_path_factory.mktemp("corpus")
    rows, bench = corpus
    spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    labels = [(i, 1, 0) for i in range(0, 90, 2)] + [(100 + i, 0, 1) for i in range(20)] + [(None, 1, 0), (7, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


def types(df):
    return dict(df.dtypes)


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def components(n, linked):
    top = list(range(n))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = root(i), root(j)
                top[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_quality(spark, folder, corpus):
    got = queries.QUERIES["op2_quality"](spark, folder)
    assert {k: types(got)[k] for k in ("doc_id", "held_out", "score", "predicted")} == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = got.collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(str(d[0]) for d in corpus[0])
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) and r.held_out == (fold(r.doc_id) == 0)
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 130]
    assert len(held) > 10 and all(r.predicted == int(r.doc_id < 90) for r in held)


def test_line_classes(spark, folder, corpus):
    got = queries.QUERIES["op3_line_dedup"](spark, folder).collect()
    want = []
    for i, text, _ in corpus[0]:
        for no, line in enumerate((text or "").split("\n") if text is not None else []):
            if line.strip():
                want.append((i, no, line))
    assert sorted((str(r.doc_id), r.line_no) for r in got) == sorted((str(i), no) for i, no, _ in want)
    runs = [{x[k:k + 7] for k in range(max(1, len(x) - 6))} for *_, x in want]
    root = components(len(want), lambda i, j: 10 * len(runs[i] & runs[j]) >= 8 * len(runs[i] | runs[j]))
    of = {}
    for (i, no, _), k in zip(want, root, strict=True):
        of.setdefault((i, no), set()).add(k)
    classes, both = {}, set()
    for r in got:
        classes.setdefault(r.class_id, []).append(r)
        if len(of[r.doc_id, r.line_no]) == 1:
            both.add((r.class_id, min(of[r.doc_id, r.line_no])))
    assert len({c for c, _ in both}) == len({k for _, k in both}) == len(both) and len(classes) == len(set(root))
    assert all(r.copies == len(own) for own in classes.values() for r in own) and all(any(r.kept for r in own) for own in classes.values())


def test_mixing(spark, folder, corpus):
    query = queries.QUERIES["op5_mixing"]
    got = query(spark, folder)
    assert {k: types(got)[k] for k in ("doc_id", "size", "source_size", "target", "taken")} == {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"}
    rows = got.collect()
    assert sorted(map(str, rows)) == sorted(map(str, query(spark, folder).collect()))
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((str(r.doc_id), r.size) for r in rows) == sorted((str(i), words(t)) for i, t, _ in corpus[0])
    size = {}
    for _, text, source in corpus[0]:
        size[source] = size.get(source, 0) + words(text)
    order = sorted(s for s in size if s is not None) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full = set()
    while True:
        left = sum(size.values()) - sum(3 * size[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in size if x not in full) for s in size if s not in full}
        over = {s for s in share if share[s] > 3 * size[s]}
        if not over:
            break
        full |= over
    want = {**share, **{s: 3.0 * size[s] for s in full}}
    of = {}
    for i, _, source in corpus[0]:
        of.setdefault(i, set()).add(source)
    taken = {}
    for r in rows:
        assert r.taken in {k * r.size for k in range(4)}
        assert any(r.source_size == size[s] and abs(r.target - want[s]) < 1e-6 for s in of[r.doc_id])
        if len(of[r.doc_id]) == 1:
            taken[min(of[r.doc_id], key=str)] = taken.get(min(of[r.doc_id], key=str), 0) + r.taken
    assert all(abs(taken.get(s, 0) - want[s]) <= 130 for s in size if s not in ("s2", None))


def test_sharding(spark, folder, corpus):
    got = queries.QUERIES["op6_sharding"](spark, folder)
    assert [types(got)[k] for k in ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")] == ["bigint", "bigint", "bigint", "string", "int", "bigint", "int"]
    rows = got.collect()
    body = lambda t: (t or "").encode()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted((str(i), len(body(t)) + 1, zlib.crc32(body(t))) for i, t, _ in corpus[0])
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert set(by) == set(range(16)) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    copies = {}
    for r in rows:
        copies.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(s) == 1 for s in copies.values()) >= 0.9 * len(copies)  # copies stay together


def test_language_model(spark, folder, corpus):
    got = queries.QUERIES["op7_language_model"](spark, folder)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert [types(got)[k] for k in names] == ["bigint", "boolean", "bigint", "bigint", "bigint", "double", "double"]
    counts = {}
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", lower(t)), "\n"]
    for i, text, _ in corpus[0]:
        if fold(i) != 1:
            for w in tokens(text):
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), fold(i) == 1, len(w), sum(x in counts for x in w), n, round(sum(np.log10((counts.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in w), 5)) for i, w in ((i, tokens(t)) for i, t, _ in corpus[0]))
    rows = got.collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows) == want
    assert all(r.score < 0 for r in rows)


def test_probabilities_of_all_words_sum_to_one():
    """After any state: the classes sum to one, and so do the modelled words of each class; the scores of a text are sums of these."""
    rng = np.random.default_rng(3)
    net = language_model.Network.start(rng.integers(1, 50, language_model.MODELLED), rng.integers(1, 50, language_model.TAILS).astype(float))
    net.flat += rng.normal(0, 0.3, len(net.flat)).astype(np.float32)
    symbols = language_model.MODELLED + language_model.TAILS
    for h in rng.uniform(-1, 1, (3, language_model.HIDDEN)).astype(np.float32):
        logs = net.log_probability(np.repeat(h[None], symbols, 0), np.arange(symbols))
        assert abs(np.exp(logs.astype(np.float64)).sum() - 1) < 1e-4
    texts = [rng.integers(0, symbols, k) for k in (1, 5, 40, 700)]
    together = language_model.score_symbols(net, texts, 0)
    for text, score in zip(texts, together, strict=True):
        h, last, total = np.zeros((1, language_model.HIDDEN), np.float32), 0, 0.0
        for x in text:
            states, _ = net.steps(np.array([[last]]), h, False)
            h, last = states[-1], x
            total += float(net.log_probability(h, np.array([x]))[0])
        assert abs(total / np.log(10) - score) < 1e-3 * max(1, abs(score))


def test_pipeline_against_plain_python(spark, folder, corpus):
    """Each stage on all that its predecessor kept, and ``run``."""
    rows, bench = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    kept = [(i, t, s) for i, t, s in rows if quality.score_texts(model, [t or ""])[0] >= 0.3]
    assert 90 < len(kept) < len(rows) - 20

    grams = []
    for _, text, _ in kept:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        grams.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = components(len(kept), lambda i, j: bool(grams[i]) and 100 * len(grams[i] & grams[j]) >= 80 * len(grams[i] | grams[j]))
    least = {}
    for k, (r, g) in enumerate(zip(kept, grams, strict=True)):
        key = ("own", k) if not g else root[k]
        least.setdefault(key, []).append((r[0] is None, r[0] or 0, k))
    apart = [kept[min(v)[2]][0] for v in least.values()]

    windows = set()
    for _, text in bench:
        w = WORD.findall(lower(text))
        windows |= {tuple(w[k:k + min(13, len(w))]) for k in range(len(w) - min(13, len(w)) + 1)}
    texts = {}
    for i, t, _ in kept:
        texts.setdefault(i, []).append(t)

    def clean(text):
        w, hit = WORD.findall(lower(text)), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
        return not (hit and 20 * len(hit) >= len(w))

    left = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        left = stage(spark, left, folder)
        assert left.columns == docs.columns
        left = spark.createDataFrame(left.collect(), docs.schema)
        seen[name] = [(r.doc_id, r.text) for r in left.collect()]
    assert sorted(map(str, seen["quality"])) == sorted(str((i, t)) for i, t, _ in kept)
    assert sorted(str(i) for i, _ in seen["near_duplicates"]) == sorted(map(str, apart))
    assert sorted(map(str, seen["decontamination"])) == sorted(str(x) for x in seen["near_duplicates"] if clean(x[1]))
    assert len(seen["decontamination"]) < len(seen["near_duplicates"])
    assert set(seen["mixing"]) <= set(seen["decontamination"])
    final = corpus_pipeline.run(spark, folder).collect()
    times = {}
    for r in final:
        times[r.doc_id, r.text_crc32] = times.get((r.doc_id, r.text_crc32), 0) + 1
    again = {}
    for i, t in seen["mixing"]:
        again[i, zlib.crc32((t or "").encode())] = again.get((i, zlib.crc32((t or "").encode())), 0) + 1
    assert times == again and max(times.values()) <= 3
    count = np.bincount([r.shard for r in final], minlength=16)
    assert count.max() - count.min() <= 1
