"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is good or bad. A line's evidence is the make-up of its characters and that of the lines before and
after it; a transition weight ties neighbouring labels. Forward-backward gives each line's marginal, whose mean
weighted by line length is the document's quality, calibrated by a logistic curve fitted on the training documents.

Training lines carry their document's label. It uses whole documents: a bounded sample of at most ``SAMPLE`` labelled documents outside
the held-out fold, in the order of a hash, as far as their lines together stay within ``SAMPLE_LINES`` (the first one is always taken). Features come from
executors, so the fit in the driver runs on at most SAMPLE_LINES lines (or one document) of ``FEATURES`` numbers. Every text is scored whole.

Null text counts as empty: one line of no characters, scored like any other. Without labels of both classes every
score is 0.5. Null labels are ignored; of several labels of a doc_id the one of the least hash counts. Of several rows of one doc_id that of the least hash of its text is in the fit; they give
repeated rows in the result; extra columns are ignored by the query and kept by the stage.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import crc_mod, free, table

SAMPLE, SAMPLE_LINES, ROUNDS, THRESHOLD = 3000, 400_000, 150, 0.3
CLASSES = ("newline", "space", "lower", "upper", "digit", "stop", "bang", "bar", "symbol", "other")
FEATURES = 19


KEPT: dict = {}


def _classes() -> np.ndarray:
    """Class of every code point below 65536; the rest are ``other``. Made once per task."""
    if "table" in KEPT:
        return KEPT["table"]
    out = KEPT["table"] = np.full(65537, 9, np.uint8)
    for i in range(65536):
        c = chr(i)
        if c == "\n":
            out[i] = 0
        elif c.isspace():
            out[i] = 1
        elif c.isupper():
            out[i] = 3
        elif c.isalpha():
            out[i] = 2
        elif c.isdigit():
            out[i] = 4
        elif c in ".,;:?'\"()-":
            out[i] = 5
        elif c == "!":
            out[i] = 6
        elif c == "|":
            out[i] = 7
        elif i < 128:
            out[i] = 8
    return out


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of each text, their lengths, their features (lines x FEATURES), in order."""
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _classes()[np.minimum(codes, 65536)]
    ends = np.flatnonzero(kind == 0)
    starts = np.concatenate(([0], ends[:-1] + 1))
    counts = np.empty((len(starts), 12), np.float64)
    for c in range(1, 10):
        counts[:, c] = np.add.reduceat(kind == c, starts, dtype=np.int32)
    same = np.empty(len(codes), bool)
    same[1:], same[0] = (codes[1:] == codes[:-1]) & (kind[1:] >= 5), False  # a mark repeated
    counts[:, 10] = np.add.reduceat(same, starts, dtype=np.int32)
    start_word = np.empty(len(codes), bool)
    start_word[1:], start_word[0] = (kind[1:] > 1) & (kind[:-1] <= 1), kind[0] > 1
    counts[:, 11] = np.add.reduceat(start_word, starts, dtype=np.int32)
    # A word equal to the one before it in its line: equal sums of mixed code points and equal lengths.
    begin = np.flatnonzero(start_word)
    repeated = np.zeros(len(starts))
    if len(begin):
        mixed = codes * np.uint32(2654435761)
        mixed ^= mixed >> np.uint32(15)
        mixed[kind <= 1] = 0
        sums = np.add.reduceat(mixed, begin, dtype=np.uint32)
        sizes = np.add.reduceat(kind > 1, begin, dtype=np.int32)
        line = np.searchsorted(starts, begin, "right") - 1
        again = (sums[1:] == sums[:-1]) & (sizes[1:] == sizes[:-1]) & (line[1:] == line[:-1])
        repeated = np.bincount(line[1:][again], minlength=len(starts)).astype(np.float64)
    length = (ends - starts).astype(np.float64)
    n, words = np.maximum(length, 1.0), np.maximum(counts[:, 11], 1.0)
    letters = np.maximum(counts[:, 2] + counts[:, 3], 1.0)
    upper = counts[:, 3] / letters
    odd = counts[:, 8] / words
    f = np.stack([
        np.ones_like(n), np.log1p(length) / 5, np.log1p(counts[:, 11]) / 4, np.minimum(length / words, 20) / 10,
        upper, (upper > 0.4) * 1.0, counts[:, 4] / n, counts[:, 5] / words, np.minimum(counts[:, 6] / words, 2), np.minimum(counts[:, 7] / words, 2),
        np.minimum(odd, 3), (odd > 0.3) * 1.0, np.minimum(counts[:, 10] / words, 3), counts[:, 9] / n, counts[:, 1] / n, (length == 0) * 1.0,
        repeated / words, (repeated > 0.3 * words) * 1.0, (counts[:, 7] > 0.2 * words) * 1.0,
    ], axis=1)
    breaks = np.array([t.count("\n") + 1 for t in texts])
    return breaks, length, f


def _with_neighbours(lines: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Own, previous and next line's features; zeros beyond a document's ends."""
    first = np.concatenate(([0], np.cumsum(lines)[:-1]))
    before, after = np.zeros_like(f), np.zeros_like(f)
    before[1:], after[:-1] = f[:-1], f[1:]
    before[first], after[first + lines - 1] = 0, 0
    return np.concatenate([f, before, after], axis=1)


def _marginals(lines: np.ndarray, emission: np.ndarray, stay: np.ndarray):
    """P(good) of every line and, for the gradient, the expected counts of the four transitions.

    ``emission``: log-odds of good; ``stay``: 2 x 2 transition scores. All documents step along together, those
    with more lines first, so a step works on a leading part.
    """
    order = np.argsort(-lines, kind="stable")
    first = np.concatenate(([0], np.cumsum(lines)[:-1]))[order]
    size = lines[order]
    alpha = np.zeros((len(emission), 2))
    beta = np.zeros((len(emission), 2))
    score = np.stack([np.zeros_like(emission), emission], axis=1)
    alpha[first] = score[first]
    live = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right") if len(size) else []
    for t in range(1, size[0] if len(size) else 0):
        at = first[:live[t]] + t
        prev = alpha[at - 1]
        for s in (0, 1):
            alpha[at, s] = score[at, s] + np.logaddexp(prev[:, 0] + stay[0, s], prev[:, 1] + stay[1, s])
    for t in range((size[0] if len(size) else 0) - 1, 0, -1):
        at = first[:live[t]] + t
        tail = beta[at] + score[at]
        for s in (0, 1):
            beta[at - 1, s] = np.logaddexp(stay[s, 0] + tail[:, 0], stay[s, 1] + tail[:, 1])
    total = alpha + beta
    good = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500)))
    inner = np.ones(len(emission), bool)
    inner[first] = False
    here = np.flatnonzero(inner)
    log_z = np.logaddexp(total[here, 0], total[here, 1])
    pairs = np.array([[np.exp(alpha[here - 1, a] + stay[a, b] + score[here, b] + beta[here, b] - log_z).sum() for b in (0, 1)] for a in (0, 1)])
    return good, pairs


def _documents(lines: np.ndarray, length: np.ndarray, good: np.ndarray) -> np.ndarray:
    first = np.concatenate(([0], np.cumsum(lines)[:-1]))
    return np.add.reduceat((length + 1) * good, first) / np.add.reduceat(length + 1, first)


def _logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit(lines: np.ndarray, length: np.ndarray, f: np.ndarray, quality: np.ndarray, rounds: int = ROUNDS) -> dict:
    """Maximum conditional likelihood by Adam, then the calibration."""
    x, label = _with_neighbours(lines, f), np.repeat(quality, lines)
    first = np.concatenate(([0], np.cumsum(lines)[:-1]))
    inner = np.ones(len(x), bool)
    inner[first] = False
    seen = np.zeros((2, 2))
    for v in (0, 1):
        seen[v, v] = (inner & (label == v)).sum()
    w = np.zeros(x.shape[1] + 4)
    m, v2 = np.zeros_like(w), np.zeros_like(w)
    n = len(x)
    for i in range(1, rounds + 1):
        good, pairs = _marginals(lines, x @ w[:-4], w[-4:].reshape(2, 2))
        g = np.concatenate([x.T @ (label - good), (seen - pairs).ravel()]) / n - 1e-4 * w
        m, v2 = 0.9 * m + 0.1 * g, 0.99 * v2 + 0.01 * g * g
        w += 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v2 / (1 - 0.99**i)) + 1e-9)
    good, _ = _marginals(lines, x @ w[:-4], w[-4:].reshape(2, 2))
    z = _logit(_documents(lines, length, good))
    scale, shift = 1.0, 0.0
    for _ in range(50):  # Newton steps with a little ridge
        p = 1 / (1 + np.exp(-(scale * z + shift)))
        r, h = quality - p, p * (1 - p)
        a = np.array([[(h * z * z).sum() + 0.1, (h * z).sum()], [(h * z).sum(), h.sum() + 0.1]])
        step = np.linalg.solve(a, np.array([(r * z).sum() - 0.1 * (scale - 1), r.sum() - 0.1 * shift]))
        scale, shift = scale + np.clip(step[0], -1, 1), shift + np.clip(step[1], -1, 1)
    return {"w": w, "scale": max(scale, 0.05), "shift": shift}


def score_texts(model: dict | None, texts: list[str]) -> np.ndarray:
    if model is None or not texts:
        return np.full(len(texts), 0.5)
    lines, length, f = line_features(texts)
    good, _ = _marginals(lines, _with_neighbours(lines, f) @ model["w"][:-4], model["w"][-4:].reshape(2, 2))
    return 1 / (1 + np.exp(-(model["scale"] * _logit(_documents(lines, length, good)) + model["shift"])))


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, most_lines: int = SAMPLE_LINES) -> dict | None:
    """A model from at most ``sample`` labelled documents outside the held-out fold, of ``most_lines`` lines in all; None without both classes."""
    spark = documents.sparkSession
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_mod(F.col("doc_id"), 5) != 0))
    chosen = known.groupBy("doc_id").agg(F.min_by("quality", F.xxhash64("doc_id", "quality")).alias("quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toPandas()
    if chosen["quality"].nunique() < 2:
        return None
    small = F.broadcast(spark.createDataFrame(chosen, "doc_id bigint, quality int"))  # at most ``sample`` rows
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    rows = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_h")).join(small, "doc_id")
    # Numbers only: one text of each doc_id, while their lines stay within the bound.
    least = F.min(F.struct("_h", (F.coalesce(breaks, F.lit(0)) + 1).cast("long").alias("lines"))).alias("m")
    picked = rows.groupBy("doc_id", "quality").agg(least).select("doc_id", "quality", "m.*").toPandas().sort_values(["_h", "doc_id"], ignore_index=True)
    picked = picked[(picked["lines"].cumsum() <= most_lines) | (picked.index == 0)]
    if picked["quality"].nunique() < 2:
        return None
    taken = F.broadcast(spark.createDataFrame(picked[["doc_id", "quality", "_h"]], "doc_id bigint, quality int, _h bigint"))
    rows = rows.drop("quality").join(taken, ["doc_id", "_h"])

    def features(batches):
        for pdf in batches:
            if len(pdf):
                texts = pdf["text"].fillna("").tolist()
                lines, length, f = line_features(texts)
                cut = np.cumsum(lines)[:-1]
                yield pd.DataFrame({"doc_id": pdf["doc_id"], "h": pdf["_h"], "quality": pdf["quality"], "length": [a.tobytes() for a in np.split(length, cut)], "f": [a.astype(np.float32).tobytes() for a in np.split(f, cut)]})

    found = rows.mapInPandas(features, "doc_id bigint, h bigint, quality int, length binary, f binary")
    got = found.groupBy("doc_id", "h", "quality").agg(F.first("length").alias("length"), F.first("f").alias("f")).toPandas().sort_values(["doc_id", "h"])
    length = [np.frombuffer(b) for b in got["length"]]
    f = np.concatenate([np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in got["f"]]).astype(np.float64)
    return fit(np.array([len(a) for a in length]), np.concatenate(length), f, got["quality"].to_numpy(np.float64))


def quality_scores(documents: DataFrame, model: dict | None, text: str = "text", name: str = "score") -> DataFrame:
    """``documents`` with their score in the column ``name``."""
    columns = documents.columns
    schema = StructType([*documents.schema.fields, StructField(name, DoubleType())])

    def score(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 1000):
                part = pdf.iloc[at:at + 1000]
                yield part.assign(**{name: score_texts(model, part[text].fillna("").tolist())})[[*columns, name]]

    return documents.mapInPandas(score, schema)


def _scores_only(documents: DataFrame, model: dict | None) -> DataFrame:
    def score(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 1000):
                part = pdf.iloc[at:at + 1000]
                yield pd.DataFrame({"doc_id": part["doc_id"], "score": score_texts(model, part["text"].fillna("").tolist())})

    return documents.select("doc_id", "text").mapInPandas(score, "doc_id bigint, score double")


def op2_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = train(documents, table(spark, sf_dir, "labels"))
    return _scores_only(documents, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold."""
    model = train(docs, table(spark, sf_dir, "labels"))
    name, = free(docs.columns, "score")
    return quality_scores(docs, model, name=name).where(F.col(name) >= THRESHOLD).drop(name)
