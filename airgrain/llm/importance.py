"""Importance resampling towards a target distribution, over hashed n-grams from prefix CRCs.

Documents are scanned once: separators become single spaces, letters A-Z are lowered, and the running CRC after each word is kept. An n-gram's
CRC comes from two of these prefixes. With A all before it, B itself: crc(AB) = shift(crc(A), bytes of B) xor crc(B), where ``shift`` feeds zero bytes to the
register; it is linear over GF(2), so a shift of 2^k bytes is four table look-ups, and shifting crc(A) cancels it from crc(AB). No n-gram's bytes are read again,
whatever its length. The texts of a batch follow each other in one scan; n-grams that would span two texts are left out.

Pass one counts buckets (the CRC modulo ``buckets``) of the raw corpus and of the target; a task sends one row per bucket. Pass two sums the buckets' gains over
each text, with the gains sent to the executors (``buckets`` numbers). The draw adds Gumbel noise from a hash of the id and takes the highest scores: a histogram of
scores gives the cut, so only drawn rows are ordered, in sorted ranges (``common.ranked``). Long texts are scanned in pieces, the running CRC going on.

Null and empty texts have no features and weight 0. A null id counts as empty text in the hash and comes first among ties. Every row, also a repeated one, gives
its own row and may be drawn; rows alike in id and score are ordered by their number of features. An empty corpus gives no rows; with an empty target all target counts are 0.
Extra columns are ignored.
"""

from __future__ import annotations

import math
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ranked, saved, table

NGRAM, BUCKETS, SEED, LEAST_WORDS, PERCENT = 1, 10_000, 2024, 20, 10
PIECE, BLOCK = 1 << 20, 1 << 16  # bytes of a text cut at once, words scanned at once
# Each byte's place in the normalised text: A-Z lowered, digits, a-z and all beyond ASCII kept, the rest a space.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
U = np.uint32


def _step_table() -> np.ndarray:
    """The register after one zero byte, by its lowest byte: the reflected CRC-32 polynomial."""
    register = np.arange(256, dtype=U)
    for _ in range(8):
        register = np.where(register & U(1), (register >> U(1)) ^ U(0xEDB88320), register >> U(1))
    return register


STEP = _step_table()


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by its images of each byte at each of four places."""
    return tables[0][crc & U(255)] ^ tables[1][(crc >> U(8)) & U(255)] ^ tables[2][(crc >> U(16)) & U(255)] ^ tables[3][crc >> U(24)]


def _shift_tables(doublings: int = 32) -> list[np.ndarray]:
    """Of a shift by 1, 2, 4, ... zero bytes."""
    values = np.arange(256, dtype=U)
    one = np.stack([(values << U(8 * b) >> U(8)) ^ STEP[(values << U(8 * b)) & U(255)] for b in range(4)])
    out = [one]
    for _ in range(doublings - 1):
        out.append(np.stack([_apply(out[-1], row) for row in out[-1]]))
    return out


SHIFTS = _shift_tables()


def shifted(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Each CRC after ``size`` zero bytes more."""
    out = crc.copy()
    for k in range(int(size.max(initial=0)).bit_length()):
        some = np.flatnonzero(size >> k & 1)
        out[some] = _apply(SHIFTS[k], out[some])
    return out


def _after_space(crc: np.ndarray) -> np.ndarray:
    """The CRCs with one space more."""
    register = ~crc
    return ~((register >> U(8)) ^ STEP[(register ^ U(32)) & U(255)])


def _blocks(texts: list[bytes]):
    """Words of the normalised texts in order, and the text each is of, about ``BLOCK`` at a time."""
    words, counts, of, held = [], [], [], 0
    for i, text in enumerate(texts):
        text, at = text.translate(NORMAL), 0
        while at < len(text):
            cut = text.find(b" ", at + PIECE) if len(text) - at > PIECE else -1
            cut = len(text) if cut < 0 else cut
            some = text[at:cut].split()
            at = cut
            if some:
                words += some
                counts.append(len(some))
                of.append(i)
                held += len(some)
            if held >= BLOCK:
                yield words, np.repeat(of, counts)
                words, counts, of, held = [], [], [], 0
    if words:
        yield words, np.repeat(of, counts)


def ngrams(texts: list[bytes], longest: int):
    """(text of each n-gram, its CRC, n) for the n-grams of 1 to ``longest`` words, block by block."""
    crc, place = 0, 0
    kept = (np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.int64))  # text, CRC before and place of the last words
    for words, of in _blocks(texts):
        after = np.fromiter(accumulate(words, lambda c, w: crc32(w, crc32(b" ", c)), initial=crc), U, len(words) + 1)
        before, after, crc = _after_space(after[:-1]), after[1:], int(after[-1])
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = place + np.cumsum(size + 1)
        place = int(end[-1])
        old = len(kept[0])
        of, before, begin = (np.concatenate(x) for x in zip(kept, (of, before, end - size), strict=True))
        for n in range(1, longest + 1):
            first = np.arange(max(0, old - n + 1), len(of) - n + 1)
            last = first + n - 1
            first, last = first[last >= old], last[last >= old]
            if n > 1:
                whole = of[first] == of[last]
                first, last = first[whole], last[whole]
            yield of[first], after[last - old] ^ shifted(before[first], end[last - old] - begin[first]), n
        back = len(of) - (longest - 1) if longest > 1 else len(of)
        kept = tuple(x[max(0, back):] for x in (of, before, begin))


def _texts(batch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def bucket_counts(documents: DataFrame, longest: int = NGRAM, buckets: int = BUCKETS) -> DataFrame:
    """bucket, c: n-grams of all texts, repeats counted."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, crc, _ in ngrams(_texts(batch), longest):
                total += np.bincount(crc % U(buckets), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(seen, pa.int32()), "c": pa.array(total[seen], pa.int64())})

    return documents.select("text").mapInArrow(count, "bucket int, c bigint").groupBy("bucket").agg(F.sum("c").alias("c"))


def bucket_gains(corpus: DataFrame, target: DataFrame, longest: int = NGRAM, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln) of the target's over the corpus's smoothed share of each bucket."""
    counts = []
    for texts in (corpus, target):
        c = np.zeros(buckets, np.int64)
        got = bucket_counts(texts, longest, buckets).toPandas()  # one row per bucket
        c[got["bucket"].to_numpy(np.int64)] = got["c"].to_numpy(np.int64)
        counts.append(c)
    raw, wanted = float(counts[0].sum() + buckets), float(counts[1].sum() + buckets)
    return np.array([math.floor(1000 * math.log(float(t + 1) * raw / (float(s + 1) * wanted))) for s, t in zip(*(c.tolist() for c in counts), strict=True)], np.int64)


def weights(documents: DataFrame, gains: np.ndarray, longest: int = NGRAM) -> DataFrame:
    """doc_id, n_words, n_features, weight (the floored mean of the gains of a text's n-grams)."""
    buckets = len(gains)

    def score(batches):
        for batch in batches:
            texts = _texts(batch)
            size = len(texts)
            n_words, n, total = (np.zeros(size, np.int64) for _ in range(3))
            for of, crc, k in ngrams(texts, longest):
                found = np.bincount(of, minlength=size)
                n += found
                n_words += found if k == 1 else 0
                total += np.bincount(of, gains[crc % U(buckets)], size).astype(np.int64)  # whole numbers far below 2^53
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_words": n_words, "n_features": n, "weight": total // np.maximum(n, 1)})

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def resample(documents: DataFrame, target: DataFrame, longest: int = NGRAM, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank (null: not drawn) of every document."""
    found = weights(documents, bucket_gains(documents, target, longest, buckets), longest)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    rows = saved(found.withColumn("score", (F.col("weight") + noise).cast("long")), "importance")
    able = rows.where(F.col("n_words") >= least_words)
    # Scores are whole thousandths of logarithms, so there are some ten thousand different ones at any size.
    scores = able.groupBy("score").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("score").desc()).toPandas()
    quota = percent * int(scores["n"].sum()) // 100
    if quota == 0:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    cut = int(scores["score"][np.searchsorted(scores["n"].cumsum(), quota)])
    near = (F.col("n_words") >= least_words) & (F.col("score") >= cut)
    drawn = ranked(rows.where(near), [F.col("score").desc(), "doc_id", "n_features"], "rank")
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank")).cast("long"))
    return drawn.unionByName(rows.where(~near).withColumn("rank", F.lit(None).cast("long")))


def op11_importance_resampling(spark, sf_dir):
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
