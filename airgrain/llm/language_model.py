"""Language-model scoring: a gated recurrent network with a class-factored softmax.

Counts of all words are gathered from all training documents. The ``MODELLED`` most frequent words (with the end mark) are
the network's vocabulary, dealt to ``CLASSES`` classes by frequency; every other word belongs to one of ``TAILS`` tail
classes by its bytes (a fixed rule), inside which its probability follows the counts. So
log P(word) = log P(class | state) + log P(word | class, state), or + log (c + 0.5) / Z(class) in the tail, where one 0.5 is kept for unseen words.

Training is data parallel and every training row takes part once: rows are dealt to ``ROUNDS`` rounds by a hash of id and text, those of a
round to shards of about ``SHARD`` bytes of text (so of no more words) by a hash that also tells equal rows apart. Shards run truncated
backpropagation in numpy, windows of ``STEPS`` words with the state carried on through each text (in segments of ``SEGMENT`` words); texts follow each other in ``LANES``
streams of like length, so that windows are full. The shards' weights are
averaged in a tree, and the next round starts from the average. Output biases start at the corpus frequencies.

Scoring reads each text whole: documents step together in streams, the state carried across windows from the first word to the
end mark. Counts of the ``HEAD`` most frequent words travel to the executors; rarer words meet their counts in a shuffled join.

Null and empty texts are the end mark alone. Repeated rows give repeated rows. With no training
document every count is 0. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, saved, table

HEAD, MODELLED, CLASSES, TAILS, HIDDEN, STEPS, LANES, SCORE_LANES, SEGMENT, SCORED, BYTES = 50_000, 1024, 32, 32, 16, 16, 128, 512, 4096, 5000, 1 << 24
SHARD, ROUNDS, RATE, FAN, BLOCK, BUILT = 1 << 22, 2, 0.02, 32, 16, 1 << 20
END = b"\n"  # no word holds whitespace
PER = MODELLED // CLASSES
KIND = np.concatenate([np.arange(MODELLED) // PER, CLASSES + np.arange(TAILS)])  # a symbol's class


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Where each text begins among all words, the words' numbers, and the different words (binary) that have these numbers.

    Texts (no nulls) are lower-cased A-Z and split at ASCII whitespace; each ends with the end mark.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    bounds = lists.offsets.to_numpy()
    coded = lists.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
    words, number, bounds = coded.dictionary, coded.indices.to_numpy(), bounds - bounds[0]
    empty = pc.index(words, "").as_py()  # beside whitespace at an end
    if empty >= 0:
        kept = number != empty
        bounds = np.concatenate([[0], np.cumsum(kept)])[bounds]
        number = number[kept]
        number = number - (number > empty)
        words = pa.concat_arrays([words[:empty], words[empty + 1:]])
    ends = np.arange(len(texts)) + bounds[1:]
    out, inside = np.full(len(number) + len(texts), len(words), np.int32), np.ones(len(number) + len(texts), bool)
    inside[ends] = False
    out[inside] = number
    return bounds + np.arange(len(bounds)), out, pa.concat_arrays([words.cast(pa.binary()), pa.array([END], pa.binary())])


def _slices(batches):
    """Batches of at most ``SCORED`` rows that end with the row in which another ``BYTES`` bytes of text are full."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // BYTES
        rows = np.arange(len(size)) // SCORED
        cuts = (np.flatnonzero((np.diff(size) > 0) | (np.diff(rows) > 0)) + 1).tolist()
        for at, end in zip([0, *cuts], [*cuts, len(size)], strict=True):
            if end > at:
                yield batch.slice(at, end - at)


def _listed(words: pa.Array) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()


def tail_classes(words: pa.Array) -> np.ndarray:
    """Of words (binary, none empty) outside the network's vocabulary: by the first non-ASCII letter, else the first byte, and the closing mark."""
    words = words.cast(pa.binary())
    _, bounds, data = words.buffers()
    bounds = np.frombuffer(bounds, np.int32)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8)[:bounds[-1]] if len(words) else np.zeros(0, np.uint8)
    kind = data[bounds[:-1]] & 7
    letters = np.flatnonzero(data >= 0xC0)
    letters = letters[letters >= bounds[0]]
    of = np.searchsorted(bounds, letters, "right") - 1
    first = np.flatnonzero(np.diff(of, prepend=-1))
    at, of = letters[first], of[first]
    after = np.where(at + 1 < bounds[of + 1], data[np.minimum(at + 1, len(data) - 1)], 0)
    kind[of] = 8 + ((after >> 2) & 7)
    return kind.astype(np.int64) + 16 * np.isin(data[bounds[1:] - 1], list(b".,;:!?"))


class Network:
    """Weights in one flat array, so that shards can be averaged."""

    SHAPES = {"x": (MODELLED + TAILS, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN), "c": (HIDDEN, CLASSES + TAILS), "cb": (CLASSES + TAILS,), "w": (CLASSES, HIDDEN, PER), "wb": (CLASSES, PER)}

    def __init__(self, flat: np.ndarray):
        self.flat, at = flat, 0
        self.part, self.gradients = {}, None
        for name, shape in self.SHAPES.items():
            n = int(np.prod(shape))
            self.part[name] = flat[at:at + n].reshape(shape)
            at += n

    @classmethod
    def start(cls, head_counts: np.ndarray, tail_totals: np.ndarray) -> "Network":
        rng = np.random.default_rng(7)
        net = cls(np.zeros(sum(int(np.prod(s)) for s in cls.SHAPES.values()), np.float32))
        net.part["x"][:] = rng.normal(0, 0.1, net.part["x"].shape)
        net.part["u"][:] = rng.normal(0, 0.2, net.part["u"].shape)
        net.part["c"][:] = rng.normal(0, 0.05, net.part["c"].shape)
        net.part["w"][:] = rng.normal(0, 0.05, net.part["w"].shape)
        counts = (head_counts + 0.5).reshape(CLASSES, PER)
        net.part["cb"][:CLASSES] = np.log(counts.sum(1))
        net.part["cb"][CLASSES:] = np.log(tail_totals + 0.5)
        net.part["cb"] -= net.part["cb"].max()
        net.part["wb"][:] = np.log(counts / counts.sum(1, keepdims=True))
        return net

    def steps(self, inputs: np.ndarray, h: np.ndarray, keep: bool, fresh: np.ndarray | None = None):
        """``inputs``: T x B symbols; ``fresh``: where a text begins, from the zero state. States after each step (T x B x H), and what the gradient needs.

        Inside, the streams lie along the last axis, so that each gate is one run of memory.
        """
        # The gates' logistic curve is a tanh of half its argument: the halves go into the weights.
        half = np.repeat(np.array([0.5, 1.0], self.flat.dtype), [2 * HIDDEN, HIDDEN])
        u, (steps, wide) = np.ascontiguousarray((self.part["u"] * half).T), inputs.shape
        moved = np.empty((steps, 3 * HIDDEN, wide), self.flat.dtype)  # becomes the gates r, z, n
        np.multiply(np.take(self.part["x"], inputs, axis=0).transpose(0, 2, 1), half[:, None], out=moved)
        states, lined = np.empty((steps + 1, HIDDEN, wide), moved.dtype), np.empty((steps if keep else 1, HIDDEN, wide), moved.dtype)
        states[0], moves = h.T, np.empty((2 * HIDDEN, wide), moved.dtype)
        begins = np.zeros(len(inputs), bool) if fresh is None else fresh.any(1)
        for t, x in enumerate(moved):
            h, new = states[t], states[t + 1]
            if begins[t]:
                h = np.where(fresh[t], np.float32(0), h)
            rz, n, gn = x[:2 * HIDDEN], x[2 * HIDDEN:], lined[t if keep else 0]
            rz += np.matmul(u[:2 * HIDDEN], h, out=moves)
            np.tanh(rz, out=rz)
            rz *= 0.5
            rz += 0.5
            np.matmul(u[2 * HIDDEN:], h, out=gn)
            n += np.multiply(rz[:HIDDEN], gn, out=new)
            np.tanh(n, out=n)
            np.subtract(h, n, out=new)
            new *= rz[HIDDEN:]
            new += n
        return states[1:].transpose(0, 2, 1), (states[:-1], moved, lined)

    @staticmethod
    def _softmax(logits: np.ndarray, weights: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log P at the flat ``place`` of some rows of ``logits`` (its last axis sums to one), which become exponentials, and the row sums.

        States lie in -1..1, so the weights bound the logits; rows are shifted only if float32 could overflow.
        """
        if np.abs(weights).sum(-2).max() > 60:
            logits -= logits.max(-1, keepdims=True)
        wide = logits.shape[-1]
        out = logits.reshape(-1)[place]
        np.exp(logits, out=logits)
        total = logits.reshape(-1, wide) @ np.ones(wide, logits.dtype)
        out -= np.log(total[place // wide])
        return out, total

    def log_probability(self, states: np.ndarray, target: np.ndarray, grad=None):
        """Natural log P(symbol | state) for rows of states; with ``grad`` adds gradients and returns that of the states.

        A last column of ones takes the biases into the products. Rows of one class are dealt to blocks of ``BLOCK``, filled with zeros, so that
        one call of each kind serves all classes; rows of zeros add nothing to a gradient.
        """
        kind = np.take(KIND, target)
        s, c = np.ones((len(target), HIDDEN + 1), states.dtype), np.concatenate([self.part["c"], self.part["cb"][None]])
        s[:, :HIDDEN] = states
        logits = s @ c
        place = np.arange(0, logits.size, logits.shape[1]) + kind
        out, total = self._softmax(logits, c, place)
        if grad is not None:
            logits *= (1 / total)[:, None]
            logits.reshape(-1)[place] -= 1
            moved = s.T @ logits
            grad["c"] += moved[:-1]
            grad["cb"] += moved[-1]
            back = logits @ c[:-1].T
        head = np.flatnonzero(kind < CLASSES)
        if len(head):
            order = head[np.argsort(kind[head].astype(np.int16), kind="stable")]
            n = np.bincount(kind[order], minlength=CLASSES)
            blocks = -(-n // BLOCK)
            # A class's rows follow each other from the beginning of its first block.
            slot = np.arange(len(order)) + np.repeat(BLOCK * (np.cumsum(blocks) - blocks) - (np.cumsum(n) - n), n)
            s_own = np.zeros((int(blocks.sum()), BLOCK, HIDDEN + 1), states.dtype)
            s_own.reshape(-1, HIDDEN + 1)[slot] = np.take(s, order, axis=0)
            w = np.concatenate([self.part["w"], self.part["wb"][:, None]], 1)
            used = np.flatnonzero(blocks)
            of_block = np.repeat(used, blocks[used])
            w_own = w[of_block]
            logits = s_own @ w_own
            place = slot * PER + target[order] % PER
            logs, total = self._softmax(logits, w, place)
            out[order] += logs
            if grad is not None:
                logits *= (1 / total).reshape(-1, BLOCK, 1)
                logits.reshape(-1)[place] -= 1
                moved = (s_own.transpose(0, 2, 1) @ logits).reshape(len(w_own), -1)
                moved = ((used[:, None] == of_block).astype(np.float32) @ moved).reshape(-1, HIDDEN + 1, PER)
                grad["w"][used] += moved[:, :-1]
                grad["wb"][used] += moved[:, -1]
                moved = np.take((logits @ w_own[:, :-1].transpose(0, 2, 1)).reshape(-1, HIDDEN), slot, axis=0)
                moved += np.take(back, order, axis=0)
                back[order] = moved
        return (out, back) if grad is not None else out

    def gradient(self, inputs, targets, alive, h, fresh=None):
        """Of one window, cut at its start and where a text begins. ``alive``: T x B. Returns the gradients, views of one flat array kept until the next call, and the last state."""
        if self.gradients is None:
            self.gradients = Network(np.zeros_like(self.flat, np.float32))
        self.gradients.flat.fill(0)
        grad = self.gradients.part
        states, (before, gates, lined) = self.steps(inputs, h, True, fresh)
        begins = np.zeros(len(inputs), bool) if fresh is None else fresh.any(1)
        _, d = self.log_probability(_cells(states, alive), _cells(targets, alive), grad)
        back = np.zeros((len(inputs), HIDDEN, inputs.shape[1]), np.float32)
        if alive.all():
            back[:] = d.reshape(states.shape).transpose(0, 2, 1)
        else:
            back.transpose(0, 2, 1)[alive] = d
        last = states[-1].copy()
        if begins.any():
            before *= ~fresh[:, None]
        # What does not wait for the step after is computed for all steps together, in place of the gates: what r, z and u's share of n
        # take of the gradient of the state.
        moves = gates.reshape(len(inputs), 3, HIDDEN, -1)
        r, z, n = moves[:, 0], moves[:, 1], moves[:, 2]
        kept, rest, inner = z.copy(), 1 - z, n * n
        np.subtract(1, inner, out=inner)
        inner *= rest
        z *= rest
        z *= before - n
        np.multiply(inner, r, out=n)
        lined *= n
        np.subtract(1, r, out=r)
        r *= lined
        carry, u = np.float32(0), self.part["u"]
        for t in reversed(range(len(inputs))):
            d, move = back[t], moves[t]
            d += carry
            move *= d
            carry = u @ gates[t]
            d = kept[t]
            d *= back[t]
            carry += d
            if begins[t]:
                carry *= ~fresh[t]
        rows = gates.transpose(0, 2, 1)
        grad["u"] += (before @ rows).sum(0)
        np.multiply(back, inner, out=n)
        symbols = inputs.ravel()
        order = np.argsort(symbols.astype(np.int16), kind="stable")
        symbols = symbols[order]
        first = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
        # Seen as complex numbers, two values are added at once.
        rows = np.take(rows.reshape(-1, 3 * HIDDEN), order, axis=0)
        grad["x"][symbols[first]] = np.add.reduceat(rows.view(np.complex64), first).view(np.float32)
        return grad, last


def _cells(values: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """The values of the cells that hold a symbol, in a row."""
    return values.reshape(-1, *values.shape[2:]) if alive.all() else values[alive]


class _Streams:
    """The texts one after another in at most ``lanes`` streams of like length, longest first, all in one array."""

    def __init__(self, symbols: list[np.ndarray], lanes: int, end: int):
        lanes = max(1, min(lanes, len(symbols)))
        size = [len(x) for x in symbols]
        heap, own = [(0, b) for b in range(lanes)], [[] for _ in range(lanes)]
        for i in sorted(range(len(size)), key=lambda i: -size[i]):
            at, lane = heapq.heappop(heap)
            own[lane].append(i)
            heapq.heappush(heap, (at + size[i], lane))
        heap.sort(key=lambda x: -x[0])
        self.order = [i for _, lane in heap for i in own[lane]]
        self.length = np.array([at for at, _ in heap], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.flat = np.concatenate([symbols[i] for i in self.order]).astype(np.int16)
        self.text = np.cumsum([0, *(size[i] for i in self.order)])[:-1]  # where the texts of ``order`` begin
        self.fresh = np.zeros(len(self.flat), bool)
        self.fresh[self.text] = True
        self.before = np.concatenate([[end], self.flat[:-1]]).astype(np.int16)  # the symbol before; at a text's beginning the end mark
        self.before[self.text] = end

    def windows(self, steps: int):
        """Streams that reach it (leading ones), which cells of steps x streams hold a symbol, and their places."""
        for at in range(0, int(self.length[0]), steps):
            live = int(np.searchsorted(-self.length, -at, "left"))
            place = np.arange(at, min(at + steps, int(self.length[0])))[:, None]
            alive = place < self.length[None, :live]
            yield live, alive, np.where(alive, place + self.begin[None, :live], self.begin[None, :live])


def score_symbols(net: Network, symbols: list[np.ndarray], end: int) -> np.ndarray:
    """log10 probability of each document's classes and modelled words."""
    out = np.zeros(len(symbols))
    if not len(symbols):
        return out
    streams = _Streams(symbols, SCORE_LANES, end)
    logs, h = np.zeros(len(streams.flat)), np.zeros((len(streams.length), HIDDEN), np.float32)
    for live, alive, place in streams.windows(32):
        states, _ = net.steps(streams.before[place], h[:live], False, streams.fresh[place])
        there = place[alive]
        logs[there] = net.log_probability(_cells(states, alive), streams.flat[there])
        h = states[-1]
    out[streams.order] = np.add.reduceat(logs, streams.text)
    return out / np.log(10)


def train_shard(flat: np.ndarray, symbols: list[np.ndarray], end: int) -> np.ndarray:
    """One pass of Adam over the windows of a shard's documents, which are cut into segments of ``SEGMENT`` symbols."""
    net = Network(flat.copy())
    m, v, root, step = np.zeros_like(net.flat), np.zeros_like(net.flat), np.empty_like(net.flat), 0
    pieces = [x[at:at + SEGMENT] for x in symbols for at in range(0, len(x), SEGMENT)]
    streams = _Streams(pieces, LANES, end)
    h = np.zeros((len(streams.length), HIDDEN), np.float32)
    for live, alive, place in streams.windows(STEPS):
        _, h = net.gradient(streams.before[place], streams.flat[place], alive, h[:live], streams.fresh[place])
        n = int(alive.sum())
        g = net.gradients.flat
        g *= np.float32(1 / n)
        step += 1
        np.subtract(g, m, out=root)
        root *= np.float32(0.1)
        m += root
        g *= g
        g -= v
        g *= np.float32(0.01)
        v += g
        # The corrections of both means as factors, so that few arrays are made.
        np.sqrt(v, out=root)
        root += np.float32(1e-6 * (1 - 0.99**step) ** 0.5)
        np.divide(m, root, out=root)
        root *= np.float32(RATE * min(1.0, n / 1000) * (1 - 0.99**step) ** 0.5 / (1 - 0.9**step))
        net.flat -= root
    return net.flat


def _training(documents: DataFrame) -> DataFrame:
    return documents.where(crc_mod(F.col("doc_id"), 5) != 1)


def word_counts(documents: DataFrame) -> DataFrame:
    """word (binary), c: over all texts with one end mark each; combined per batch before the shuffle."""
    def count(batches):
        for batch in _slices(batches):
            _, number, words = words_of(pc.fill_null(batch.column("text"), ""))
            yield pa.record_batch({"word": words, "c": np.bincount(number, minlength=len(words))})

    return documents.select("text").mapInArrow(count, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def _most_frequent(counts: DataFrame) -> pd.DataFrame:
    """The ``HEAD`` words of the highest counts, ties by word.

    A histogram of counts (64 bins a doubling) tells which words can be among them, so few more than ``HEAD`` rows are ordered and no partition
    sends rows to the driver before they are.
    """
    step = F.floor(F.log2("c") * 64)
    bins = counts.groupBy(step.alias("bin")).agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("bin", ascending=False)
    enough = bins[bins["n"].cumsum() >= HEAD]
    able = counts.where(step >= int(enough["bin"].iloc[0])) if len(enough) else counts
    return saved(able.orderBy(F.col("c").desc(), "word").limit(HEAD), "lm-head").toPandas()


def _tail_totals(counts: DataFrame, known: dict) -> np.ndarray:
    """Sum of c + 0.5 over the words of each tail class."""
    def total(batches):
        for batch in batches:
            words = batch.column("word")
            tail = _places(known.get, _listed(words)) < 0
            out = np.bincount(tail_classes(words)[tail], batch.column("c").to_numpy()[tail] + 0.5, TAILS)
            yield pa.record_batch({"kind": np.arange(TAILS, dtype=np.int32), "total": out.astype(np.float64)})  # of no words they are whole numbers

    got = counts.mapInArrow(total, "kind int, total double").groupBy("kind").agg(F.sum("total").alias("total")).toPandas()  # TAILS rows
    out = np.zeros(TAILS)
    out[got["kind"]] = got["total"]
    return out


def _train(documents: DataFrame, start: Network, known: dict) -> np.ndarray:
    spark, flat = documents.sparkSession, start.flat
    train = _training(documents).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    train = train.withColumn("round", F.pmod(F.xxhash64(F.lit("round"), "doc_id", "text"), F.lit(ROUNDS)))
    # A text has no more words than bytes, with the end mark one more.
    size = {r["round"]: r["size"] for r in train.groupBy("round").agg(F.sum(F.octet_length("text") + F.lit(1).cast("long")).alias("size")).collect()}
    for turn in sorted(size):
        shards = -(-size[turn] // SHARD)
        now = spark.sparkContext.broadcast((flat, known))
        part = F.pmod(F.xxhash64(F.lit("shard"), "doc_id", "text", F.monotonically_increasing_id()), F.lit(shards)).cast("int")

        def run(rows: pa.Table) -> pa.Table:
            weights, vocabulary = now.value
            symbols = _symbols(rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])["text"].combine_chunks(), vocabulary)
            out = train_shard(weights, symbols, vocabulary[END])
            return pa.table({"shard": rows["shard"][:1], "n": [sum(len(s) for s in symbols)], "weights": pa.array([out.astype(np.float64).tobytes()], pa.binary())})

        def average(pdf: pd.DataFrame) -> pd.DataFrame:
            n = pdf["n"].to_numpy(np.float64)
            total = sum(np.frombuffer(w) * k for w, k in zip(pdf["weights"], n, strict=True)) / n.sum()
            return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "n": [int(n.sum())], "weights": [total.tobytes()]})

        schema = "shard int, n bigint, weights binary"
        trained = saved(train.where(F.col("round") == turn).select("doc_id", "text", part.alias("shard")).groupBy("shard").applyInArrow(run, schema), "lm-weights")
        while shards > 1:
            shards = -(-shards // FAN)
            trained = saved(trained.withColumn("shard", F.pmod("shard", F.lit(shards))).groupBy("shard").applyInPandas(average, schema), "lm-weights")
        flat = np.frombuffer(trained.first()["weights"]).astype(np.float32)
    return flat


def _places(get, words: list[bytes]) -> np.ndarray:
    """``get`` of each word, -1 where there is none."""
    return np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))


def _symbols(texts: pa.Array, known: dict) -> list[np.ndarray]:
    begin, number, words = words_of(texts)
    symbol = _places(known.get, _listed(words))
    symbol = np.where(symbol < 0, MODELLED + tail_classes(words), symbol)
    return np.split(symbol[number], begin[1:-1])


def score_documents(documents: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = saved(word_counts(_training(docs)), "lm-counts")
    n, v = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    n = n or 0
    top = _most_frequent(counts)
    head = {bytes(w): int(c) for w, c in zip(top["word"], top["c"], strict=True)}
    head.setdefault(END, 0)
    modelled = [END, *[w for w in head if w != END][:MODELLED - 1]]
    known = {w: i for i, w in enumerate(modelled)}
    head_counts = np.array([head[w] for w in modelled] + [0] * (MODELLED - len(modelled)), np.float64)
    totals = _tail_totals(counts, known)
    flat = _train(docs, Network.start(head_counts, totals), known)
    # Of the words whose counts travel: place -> symbol, log10(c + 0.5), whether seen.
    words = list(head)
    symbol = _places(known.get, words)
    symbol = np.where(symbol < 0, MODELLED + tail_classes(pa.array(words, pa.binary())), symbol)
    logs = np.log10(np.array([head[w] for w in words], np.float64) + 0.5)
    seen = np.array([head[w] > 0 for w in words])
    sent = spark.sparkContext.broadcast((flat, {w: i for i, w in enumerate(words)}, symbol, logs, seen, known[END], np.log10(totals + 0.5)))
    schema = "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, logs double, score double, tail double, words array<binary>, times array<bigint>"

    def run(batches):
        flat, places, symbol, logs, seen, end, tail_logs = sent.value
        net = Network(flat.copy())
        for batch in _slices(batches):
            begin, number, words = words_of(pc.fill_null(batch.column("text"), ""))
            at_head = _places(places.get, _listed(words))
            away = at_head < 0
            # Of each different word: symbol, log10(c + 0.5) and whether it is seen, as far as its count is here.
            ids, near, there = np.where(away, MODELLED + tail_classes(words), symbol[at_head]), np.where(away, 0, logs[at_head]), seen[at_head] & ~away
            # In the tail a word's probability is its count over its class's total.
            tail = np.where(ids >= MODELLED, near - tail_logs[np.maximum(ids - MODELLED, 0)], 0)
            far = np.flatnonzero(away[number])
            of = np.searchsorted(begin, far, "right") - 1
            pairs, times = np.unique(of * len(words) + number[far], return_counts=True)
            bounds = np.searchsorted(pairs, np.arange(len(begin)) * len(words)).astype(np.int32)
            yield pa.record_batch({
                "row": batch.column("row"), "doc_id": batch.column("doc_id"), "n_tokens": np.diff(begin), "n_known": np.add.reduceat(there[number].astype(np.int64), begin[:-1]),
                "logs": np.add.reduceat(near[number], begin[:-1]), "score": score_symbols(net, np.split(ids[number], begin[1:-1]), end),
                "tail": np.add.reduceat(tail[number], begin[:-1]),
                "words": pa.ListArray.from_arrays(bounds, words.take(pa.array(pairs % len(words)))), "times": pa.ListArray.from_arrays(bounds, times)})

    read = saved(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(run, schema), "lm-scored")
    base = read.drop("words", "times")
    c = F.coalesce("c", F.lit(0))
    # Words whose counts did not travel, with how often the row holds them. While a partition's counts fit into memory many times over, nothing is sorted.
    few = v <= BUILT * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rare = read.select("row", F.inline(F.arrays_zip("words", "times")).alias("word", "times"))
    rare = rare.join(counts.hint("shuffle_hash") if few else counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(c + 0.5)).alias("rare_logs"), F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    found = base.join(rare, "row", "left")
    rare_logs = F.coalesce("rare_logs", F.lit(0.0))
    return found.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + rare_logs - F.col("n_tokens") * float(np.log10(n + 0.5 * (v + 1)))).alias("base_score"),
        (F.col("score") + F.col("tail") + rare_logs).alias("score"))


def op7_language_model(spark, sf_dir):
    scored = score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
