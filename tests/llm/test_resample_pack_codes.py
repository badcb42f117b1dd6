"""Importance resampling, packing and vector codes against plain Python, with nulls, ties, repeated rows, empty tables, long texts and clashing names."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from airgrain.llm import importance, packing, queries, vector_codes
from airgrain.llm.common import ranked

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def written(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


# --- op11


@pytest.mark.parametrize("longest", [1, 3])
def test_crc_of_every_ngram(monkeypatch, longest):
    monkeypatch.setattr(importance, "BLOCK", 7)
    monkeypatch.setattr(importance, "PIECE", 5)
    rng = random.Random(1)
    texts = ["".join(rng.choice("aZ é9,.\n中x ") for _ in range(rng.randint(0, 60))) for _ in range(60)] + ["", "x" * 40, " . "]
    got = [x for of, crc, _ in importance.ngrams([t.encode() for t in texts], longest) for x in zip(of.tolist(), crc.tolist(), strict=True)]
    want = []
    for i, text in enumerate(texts):
        w = words(text)
        want += [(i, zlib.crc32(" ".join(w[k:k + n]).encode())) for n in range(1, longest + 1) for k in range(len(w) - n + 1)]
    assert sorted(got) == sorted(want) and len(want) > 300


def test_shift_cancels_any_length():
    rng = np.random.default_rng(2)
    for size in (0, 1, 7, 1000, 70_001):
        a, b = rng.bytes(50), rng.bytes(size)
        both, first = np.array([zlib.crc32(a + b)], np.uint32), np.array([zlib.crc32(a)], np.uint32)
        assert (both ^ importance.shifted(first, np.array([size])))[0] == zlib.crc32(b)


def drawn_plainly(docs, bench, longest=1, buckets=10_000, percent=10, least=20):
    def crcs(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[k:k + n]).encode()) % buckets for n in range(1, longest + 1) for k in range(len(w) - n + 1)]

    s, t = [0] * buckets, [0] * buckets
    for texts, count in (([d[1] for d in docs], s), ([b[1] for b in bench], t)):
        for text in texts:
            for b in crcs(text):
                count[b] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + buckets) / ((x + 1) * (sum(t) + buckets)))) for x, y in zip(s, t, strict=True)]
    out = []
    for d in docs:
        b = crcs(d[1])
        weight = sum(gain[x] for x in b) // len(b) if b else 0
        h = int(hashlib.sha256(f"2024:{'' if d[0] is None else d[0]}".encode()).hexdigest()[:8], 16)
        out.append([d[0], len(b), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(d[1]))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = i + 1
    return sorted(map(repr, (tuple(r[:5]) for r in out)))


DOC = "doc_id long, text string, rank string, score int"


def documents(n=120):
    rng = random.Random(5)
    text = lambda: " ".join(rng.choice(["red", "Green", "blü", "x1", "tea", "sun"]) + rng.choice([" ", ", ", "\n"]) for _ in range(rng.randint(0, 60)))
    rows = [(i, text(), "r", i) for i in range(n)]
    rows += [(None, text() + " red" * 30, None, None), (None, "tea " * 40, None, 0), (None, "tea " * 40, None, 0), (3, rows[3][1], "r", 3), (7, "sun " * 50, "r", 1), (500, None, "r", 0), (501, "", "r", 0)]
    return rows + [(600, "blü sun " * 200_000, "long", 0)]


BENCH = [(1, "sun sun tea"), (None, "blü"), (2, None), (3, "")]


def test_resampling_query(spark, tmp_path):
    docs = documents()
    at = written(spark, tmp_path, documents=(docs, DOC), benchmark=(BENCH, "item_id long, text string"))
    got = queries.QUERIES["op11_importance_resampling"](spark, at)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and [t for _, t in got.dtypes] == ["bigint"] * 5
    assert sorted(repr(tuple(r)) for r in got.collect()) == drawn_plainly(docs, BENCH)


def test_resampling_of_longer_ngrams_and_empty_tables(spark):
    docs = spark.createDataFrame(documents(), DOC)
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = importance.resample(docs, bench, longest=2, buckets=97, percent=50).select("doc_id", "n_features", "weight", "score", "rank")
    assert sorted(repr(tuple(r)) for r in got.collect()) == drawn_plainly(documents(), BENCH, 2, 97, 50)
    assert importance.resample(docs.where("false"), bench).count() == 0
    alone = importance.resample(docs, bench.where("false"))
    assert alone.count() == docs.count() and alone.where("rank is not null").count() > 0


def test_ranked_over_many_ranges(spark):
    rows = spark.range(1000).selectExpr("if(id % 3 = 0, 5, id) as v", "id as _part")
    got = ranked(rows, ["v"], "place", per_part=50).orderBy("place").collect()
    assert [r.place for r in got] == list(range(1, 1001)) and [r.v for r in got] == sorted(r.v for r in got) and "_part" in got[0].asDict()


# --- op12


def checked(rows, docs, limits=(4096, 1024, 4096)):
    """Every id in one piece, sequences gapless and within limits. Returns the share of padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary())
    want = sorted(repr((d[0], tokenizer.encode(d[1] or "", add_special_tokens=False).ids + [2])) for d in docs)
    pieces, sequences = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= limits[0] and len(own) <= limits[1]
        if "loss_tokens" in own[0]:
            assert sum(r.loss_tokens for r in own) <= limits[2]
    for r in rows:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    total = sum(r.length for r in rows)
    assert total == sum(len(tokenizer.encode(d[1] or "", add_special_tokens=False).ids) + 1 for d in docs)
    return pieces, want, 1 - total / (len(sequences) * limits[0])


def test_packing_query(spark, tmp_path):
    from tokenizers import Tokenizer

    docs = [(d[0], d[1], d[2], d[3]) for d in documents(300)]
    at = written(spark, tmp_path, documents=(docs, DOC))
    got = queries.QUERIES["op12_packing"](spark, at)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and [t for _, t in got.dtypes] == ["bigint"] * 7
    rows = got.collect()
    _, _, padding = checked(rows, docs)
    assert padding < 0.02
    tokenizer = Tokenizer.from_file(packing.vocabulary())
    for doc_id in (1, 600, 500, 501):
        ids = np.array(tokenizer.encode(next(d[1] for d in docs if d[0] == doc_id) or "", add_special_tokens=False).ids + [2], "<u4")
        own = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.start)
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()] and own[0].doc_tokens == len(ids) == sum(r.length for r in own)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes()) for r in own)
    assert got.where("doc_id = 3").groupBy().agg(F.sum("length")).first()[0] == 2 * got.where("doc_id = 3").first().doc_tokens


def test_packed_ids_give_the_examples_back(spark):
    docs = documents(200)[:-1]
    frame = spark.createDataFrame([(d[0], d[1], d[2]) for d in docs], "doc_id long, text string, ids string").repartition(9)
    rows = packing.pack_examples(frame, limits=(512, 5, 512), cut=8).collect()
    pieces, want, _ = checked(rows, docs, (512, 5, 512))
    back = []
    for (doc_id, size), own in pieces.items():
        copies = sum(r.length for r in own) // size
        by_start = {}
        for r in own:
            by_start.setdefault(r.start, []).append(r)
        for _ in range(copies):  # repeated rows have equal ids, so any chain of pieces will do if the cuts agree
            if len({r.start for r in own}) * copies != len(own):
                break
            ids, at = [], 0
            while at < size:
                r = by_start[at].pop()
                ids += np.frombuffer(r.ids, "<u4").tolist()
                at += r.length
            back.append(repr((doc_id, ids)))
    assert len(back) >= len(want) - 8 and set(back) <= set(want)
    assert packing.pack_examples(frame.where("false")).count() == 0


def test_packing_of_prompts_and_answers(spark):
    """Three limits at once; whole examples stay in one piece where they need no cut."""
    rng = random.Random(4)
    rows = [(i, "ask " * rng.randint(0, 40), "tell " * rng.randint(0, 40)) for i in range(150)] + [(900, None, None), (901, "ask " * 300, "tell " * 10), (902, "", "tell " * 130)]
    got = packing.pack_examples(spark.createDataFrame(rows, "doc_id long, q string, a string").repartition(5), "a", "q", limits=(128, 4, 64), cut=16).collect()
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
        assert len(r.loss) == r.length and sum(r.loss) == r.loss_tokens
    assert all(sum(r.length for r in s) <= 128 and len(s) <= 4 and sum(r.loss_tokens for r in s) <= 64 for s in sequences.values())
    for i, q, a in rows:
        own = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)
        loss = b"".join(bytes(r.loss) for r in own)
        assert loss == b"\0" * len((q or "").split()) + b"\1" * (len((a or "").split()) + 1)


def test_words_are_forgotten_and_pieces_joined(monkeypatch):
    texts = ["", " ", "x" * 200 + " a " + "y<|endoftext|>z" * 20 + " q", "é ́a \x1c b\x85c d 'S it's İ ΑΣ ", "<|endoftext|> a<|startoftext|>b"] + [f"word{i} and more" for i in range(50)]
    known = packing.Ids(packing.vocabulary())
    want = [e.ids for e in known.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for piece, most in ((1 << 22, 1 << 20), (30, 10)):
        monkeypatch.setattr(packing, "PIECE", piece)
        monkeypatch.setattr(packing, "KNOWN", most)
        assert [x.tolist() for x in known.batch([t.encode() for t in texts])] == want


# --- op13


def coded_plainly(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    cells = [[math.floor(scale * float(np.float32(x))) for x in r[1]] for r in kept]
    width = len(cells[0]) // parts
    part = [[c[p * width:(p + 1) * width] for p in range(parts)] for c in cells]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, cells[i]))
    books = [[part[i][p] for i in order[:entries]] for p in range(parts)]
    away = lambda x, e: sum((a - b) ** 2 for a, b in zip(x, e, strict=True))

    def nearest():
        return [[min((away(x[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for x in part]

    for _ in range(rounds):
        found = nearest()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [part[i][p] for i in range(len(part)) if found[i][p][1] == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = nearest()
    error = [sum(d for d, _ in x) for x in found]
    by_label = {}
    for r, e in zip(kept, error, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return sorted(repr((r[0], "".join(f"{k:02x}" for _, k in x), e, by_label[r[2]], digest)) for r, x, e in zip(kept, found, error, strict=True))


def vectors(n, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(np.float32(v)) for v in rng.normal(0, 0.02, dim).round(2 if i % 2 else 5)], int(i % 4) if i % 5 else None, "x", i) for i in rng.permutation(n).tolist()]
    rows += [(None, rows[0][1], 1, "x", 0), rows[1], rows[1], (9000, None, 1, "x", 0), (9001, [None] * dim, 1, "x", 0), (9002, [float("nan")] * dim, 2, "x", 0), (-4, [float("inf")] + [0.0] * (dim - 1), 2, "x", 0)]
    return rows


VECTORS = "vec_id long, embedding array<float>, label int, code string, error long"


@pytest.mark.parametrize("n", [300, 5])
def test_vector_codes_query(spark, tmp_path, monkeypatch, n):
    monkeypatch.setattr(vector_codes, "TILE_BYTES", 2000)
    rows = vectors(n)
    at = written(spark, tmp_path, embeddings=(rows, VECTORS))
    got = queries.QUERIES["op13_vector_codes"](spark, at)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and [t for _, t in got.dtypes] == ["bigint", "string", "bigint", "bigint", "string"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == coded_plainly(rows)


def test_vector_codes_of_nothing_and_of_unequal_vectors(spark):
    frame = spark.createDataFrame(vectors(20), VECTORS)
    found, _ = vector_codes.compress(vector_codes.integer_vectors(frame.where("false")))
    assert found.count() == 0
    odd = spark.createDataFrame([(1, [0.5] * 16, 1), (2, [0.5] * 8, 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="length"):
        vector_codes.compress(vector_codes.integer_vectors(odd))
    with pytest.raises(Exception, match="scaled component"):
        vector_codes.compress(vector_codes.integer_vectors(spark.createDataFrame([(1, [1e30] * 8, 1)], "vec_id long, embedding array<float>, label int")))


def test_active_entries_agree_with_a_whole_scan_and_take_fewer_distances():
    rng = np.random.default_rng(1)
    x, entries = rng.integers(-3, 4, (400, 2)), rng.integers(-3, 4, (16, 2))
    code, distance = np.zeros(400, np.int64), np.zeros(400, np.int64)
    vector_codes.assign(x, entries, np.ones(16, bool), code, distance)
    for turn in range(20):
        new = entries.copy()
        some = rng.choice(16, 3, replace=False)
        new[some] += rng.integers(-1, 2, (3, 2))
        moved = (new != entries).any(1)
        taken = vector_codes.assign(x, new, moved, code, distance)
        whole = vector_codes.scan(x, new)
        assert (code == whole.argmin(1)).all() and (distance == whole.min(1)).all() and taken < whole.size
        entries = new
