"""Packing tokenised examples into sequences: vector bin packing by the dot-product heuristic.

An example takes room in three dimensions at once: tokens, segments (one) and loss-bearing tokens (the answer and the end mark, not the prompt). A sequence has a limit
in each. The open sequence takes, of all waiting pieces that fit, the one whose vector, scaled by the limits and weighted by how scarce each dimension
is among the waiting pieces, has the largest dot product with the room left. If none fits and at least ``CUT`` tokens are free, the longest waiting
piece is cut there, its rest waits on. Examples beyond a limit first give pieces that fill a sequence alone.

Tasks pack their own rows in windows of ``WINDOW`` pieces, so texts and ids are never shuffled; only what stands in a task's last, unfilled sequence moves on, packed
again by ``FAN`` tasks' rests at a time, in a tree, until one sequence is left open. A repeated task sees the same rows in the same order and repeats its
choices, and each level is a written table.

Tokens: a public vocabulary file, by its path (executors read it there). Words between ASCII white space do not touch each other in that vocabulary's rules,
so a Python worker keeps the ids of words it has met, from task to task (at most ``KNOWN``, then it begins anew), and long texts are tokenised piece by piece; the ids are those of the whole text.

Null and empty texts are the end mark alone. Every row, also a repeated one or one without id, is an example of its own. An empty table gives no
rows. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import repeat
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, table, worker_state

TOKENS, SEGMENTS, LOSS, CUT, WINDOW, FAN = 4096, 1024, 4096, 32, 2048, 64
END, KNOWN, LONG, PIECE, BLOCK, JOIN = 2, 1 << 20, 64, 1 << 22, 256, 64
LEFT = "doc_id bigint, start bigint, doc_tokens bigint, ids binary, loss binary, part bigint, place bigint"
PACKED = "doc_id bigint, start bigint, length bigint, loss_tokens bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary, loss binary, part bigint, place bigint"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Ids:
    """Token ids of texts; remembers words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        known = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(known.values()) + 1, bool)  # the ids that end a word
        self.closes[[i for x, i in known.items() if x.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.place, self.pool, self.held = {}, np.zeros(1 << 16, np.int32), 0
        self.first, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _split(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order of the words, their ids in it in one array, and how many each has.

        Words of letters alone go to the tokenizer ``JOIN`` at once: each ends with the one id that closes a word. Where there are more of these (a letter whose lower
        case is not a letter), word by word.
        """
        letters = np.fromiter(map(str.isalpha, words), bool, len(words))
        order = np.concatenate([np.flatnonzero(letters), np.flatnonzero(~letters)])
        joined = int(letters.sum()) // JOIN
        groups = [order[i * JOIN:(i + 1) * JOIN].tolist() for i in range(joined)]
        ids, sizes = [], []
        for group, found in zip(groups, self._encoded([" ".join([words[i] for i in g]) for g in groups]), strict=True):
            found = np.array(found, np.int32)
            ends = np.flatnonzero(self.closes[found])
            if len(ends) == len(group):
                ids.append(found)
                sizes.append(np.diff(ends, prepend=-1))
            else:
                alone = self._encoded([words[i] for i in group])
                ids.append(np.array([i for x in alone for i in x], np.int32))
                sizes.append(np.array([len(x) for x in alone]))
        rest = self._encoded([words[i] for i in order[joined * JOIN:].tolist()])
        ids.append(np.array([i for x in rest for i in x], np.int32))
        sizes.append(np.fromiter(map(len, rest), np.int64, len(rest)))
        return order, np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, words: list[bytes]) -> None:
        order, found, size = self._split([w.decode("utf-8", "replace") for w in words])
        words = [words[i] for i in order.tolist()]
        n, total = len(self.place), int(size.sum())
        while n + len(words) > len(self.first):
            self.first, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.size))
        while self.held + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.first[n:n + len(words)], self.size[n:n + len(words)] = self.held + np.cumsum(size) - size, size
        self.pool[self.held:self.held + total] = found
        self.held += total
        self.place.update(zip(words, range(n, n + len(words)), strict=True))

    def _of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words in one array, and how many each has."""
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        away = np.flatnonzero(at < 0).tolist()
        if away:
            new = list(dict.fromkeys(words[i] for i in away))
            if len(self.place) + len(new) > KNOWN and self.place:
                self.clear()
                return self._of(words)
            self._learn(new)
            at[away] = [self.place[words[i]] for i in away]
        size = self.size[at]
        end = np.cumsum(size)
        return self.pool[np.repeat(self.first[at] - end + size, size) + np.arange(end[-1] if len(end) else 0)], size

    def batch(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text. Long words are not remembered."""
        out, words, counts, rare = [], [], [], {}

        def close():
            ids, size = self._of(words)
            ends = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(counts))).astype(np.int64)]
            for i, whole in enumerate(np.split(ids, ends[1:-1]) if counts else []):
                pieces = rare.get(i)
                if pieces:  # (place among the piece's words, ids)
                    base = int(np.concatenate(([0], np.cumsum(counts)))[i])
                    local = np.concatenate(([0], np.cumsum(size[base:base + counts[i]])))
                    whole = np.insert(whole, np.repeat([local[k] for k, _ in pieces], [len(x) for _, x in pieces]), np.concatenate([x for _, x in pieces])) if pieces else whole
                out[owner[i]].append(whole)
            words.clear(), counts.clear(), rare.clear(), owner.clear()

        owner = []
        for i, text in enumerate(texts):
            out.append([])
            at = 0
            if b"<|" not in text:  # marks of that kind are known before letters are lowered
                text = text.lower()
            while at < len(text):
                cut = len(text)
                if cut - at > PIECE:
                    cut = at + max(text.rfind(b" ", at, at + PIECE), text.rfind(b"\n", at, at + PIECE)) - at
                    cut = cut if cut > at else min([x for x in (text.find(b" ", at + PIECE), text.find(b"\n", at + PIECE)) if x > 0], default=len(text))
                some = text[at:cut].split()
                at = cut
                far = [k for k, w in enumerate(some) if len(w) > LONG] if some and max(map(len, some)) > LONG else []
                if far:
                    found = self._encoded([some[k].decode("utf-8", "replace") for k in far])
                    rare[len(counts)] = [(k - j, np.array(ids, np.int32)) for j, (k, ids) in enumerate(zip(far, found, strict=True))]
                    some = [w for w in some if len(w) <= LONG]
                words += some
                counts.append(len(some))
                owner.append(i)
                if len(words) >= 1 << 18:
                    close()
        close()
        return [x[0] if len(x) == 1 else np.concatenate(x) if x else np.zeros(0, np.int32) for x in out]


class Item:
    """A piece of an example: its ids, and which bear loss (None: all)."""

    __slots__ = ("doc_id", "start", "doc_tokens", "ids", "loss")

    def __init__(self, doc_id, start, doc_tokens, ids, loss):
        self.doc_id, self.start, self.doc_tokens, self.ids, self.loss = doc_id, start, doc_tokens, ids, loss

    def vector(self) -> tuple[int, int, int]:
        return len(self.ids), 1, len(self.ids) if self.loss is None else int(self.loss.sum())

    def cut(self, at: int) -> tuple["Item", "Item"]:
        head, tail = (None, None) if self.loss is None else (self.loss[:at], self.loss[at:])
        return Item(self.doc_id, self.start, self.doc_tokens, self.ids[:at], head), Item(self.doc_id, self.start + at, self.doc_tokens, self.ids[at:], tail)

    def most(self, tokens: int, loss: int) -> int:
        """The longest leading part within both limits."""
        if self.loss is None:
            return min(len(self.ids), tokens, loss)
        return min(len(self.ids), tokens, int(np.searchsorted(np.cumsum(self.loss), loss, "right")))


def pack(items: list[Item], limits=(TOKENS, SEGMENTS, LOSS), cut: int = CUT, last: bool = True) -> tuple[list[list[Item]], list[Item]]:
    """Sequences, and what waits on: the last sequence, unless ``last`` or nothing more than ``cut`` fits into it. Each item must be within the limits."""
    size = np.array([x.vector() for x in items], np.int64).reshape(-1, 3)
    limit, waiting, items, out = np.array(limits, np.int64), np.ones(len(items), bool), list(items), []
    left = len(items)
    while left:
        room, inside = limit.copy(), []
        demand = size[waiting].sum(0) / limit  # the scarcer a dimension, the more it counts
        while left:
            fit = waiting & (size <= room).all(1)
            if fit.any():
                at = int(np.argmax(np.where(fit, size @ (demand * room / limit / limit), -1)))
                inside.append(items[at])
                waiting[at] = False
                left -= 1
                room -= size[at]
                continue
            if room[0] < cut or room[1] < 1:
                break
            at = int(np.argmax(np.where(waiting, size[:, 0], -1)))
            most = items[at].most(int(room[0]), int(room[2]))
            if most < cut:
                break
            head, items[at] = items[at].cut(most)
            inside.append(head)
            room -= head.vector()
            size[at] = items[at].vector()
        if not left and not last and (room > (cut, 0, 0)).all():
            return out, inside
        out.append(inside)
    return out, []


def _rows(sequences: list[list[Item]], number: int, keep: bool) -> dict[str, list]:
    out = {f.split()[0]: [] for f in PACKED.split(", ")}
    for i, inside in enumerate(sequences):
        offset = 0
        for x in inside:
            ids = x.ids.astype("<u4").tobytes()
            tokens, _, loss = x.vector()
            mask = None if x.loss is None else x.loss.astype(np.uint8).tobytes()
            for name, value in zip(out, (x.doc_id, x.start, tokens, loss, crc32(ids), x.doc_tokens, number + i, offset, ids if keep else None, mask if keep else None, None, None), strict=True):
                out[name].append(value)
            offset += tokens
    return out


def _waiting(items: list[Item], part: int) -> dict[str, list]:
    out = {f.split()[0]: [] for f in PACKED.split(", ")}
    for i, x in enumerate(items):
        mask = None if x.loss is None else x.loss.astype(np.uint8).tobytes()
        for name, value in zip(out, (x.doc_id, x.start, None, None, None, x.doc_tokens, None, None, x.ids.astype("<u4").tobytes(), mask, part, i), strict=True):
            out[name].append(value)
    return out


def _number(level: int, part: int) -> int:
    """The first sequence id of a task: 5 bits of level, 24 of task, 34 of sequence."""
    return level << 58 | part << 34


def pack_examples(examples: DataFrame, answer: str = "text", prompt: str | None = None, path: str | None = None, limits=(TOKENS, SEGMENTS, LOSS), end: int = END, cut: int = CUT, keep_ids: bool = True) -> DataFrame:
    """``examples``: doc_id and texts. A row per piece: doc_id, start, length, loss_tokens, ids_crc32, doc_tokens, sequence_id, offset, ids, loss.

    ``ids``: little-endian unsigned 32-bit numbers; ``loss``: a byte per id, 1 if it bears loss, null if all do. Both null without ``keep_ids``.
    """
    path = path or vocabulary()
    schema = pa.schema([(f.split()[0], pa.binary() if f.endswith("binary") else pa.int64()) for f in PACKED.split(", ")])

    def first(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        state, part = worker_state(), TaskContext.get().partitionId()
        if state.get("ids_path") != path:
            state.update(ids_path=path, ids=Ids(path))
        known = state["ids"]
        number, waiting = _number(0, part), []

        def sequences(found):
            nonlocal number
            rows = _rows(found, number, keep_ids)
            number += len(found)
            return pa.RecordBatch.from_pydict(rows, schema)

        def pieces(doc_id, ids, loss):
            x = Item(doc_id, 0, len(ids), ids, loss)
            full = []
            while any(a > b for a, b in zip(x.vector(), limits, strict=True)):
                head, x = x.cut(max(1, x.most(limits[0], limits[2])))
                full.append([head])
            waiting.append(x)
            return full

        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            columns = [[t or b"" for t in batch.column(c).cast(pa.binary()).to_pylist()] for c in batch.schema.names if c != "doc_id"]
            for at in range(0, len(doc_ids), BLOCK):
                texts, full = [known.batch(c[at:at + BLOCK]) for c in columns], []
                for doc_id, *of in zip(doc_ids[at:at + BLOCK], *texts, strict=True):
                    loss = None if len(of) == 1 else np.repeat([False, True], [len(of[0]), len(of[1]) + 1])
                    full += pieces(doc_id, np.concatenate([*of, np.array([end], np.int32)]), loss)
                    if len(waiting) >= WINDOW:
                        done, rest = pack(waiting, limits, cut, last=False)
                        full += done
                        waiting[:] = rest
                if full:
                    yield sequences(full)
        done, rest = pack(waiting, limits, cut, last=False)
        if done:
            yield sequences(done)
        if rest:
            yield pa.RecordBatch.from_pydict(_waiting(rest, part), schema)

    def merge(level: int, last: bool):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            group = int(pdf["group"].iloc[0])
            items = [
                Item(None if pd.isna(r.doc_id) else int(r.doc_id), int(r.start), int(r.doc_tokens), np.frombuffer(r.ids, "<u4"), None if r.loss is None else np.frombuffer(r.loss, np.uint8).astype(bool))
                for r in pdf.sort_values(["part", "place"]).itertuples()]
            done, rest = pack(items, limits, cut, last)
            rows = [_rows(done, _number(level, group), keep_ids), _waiting(rest, group)]
            out = {k: rows[0][k] + rows[1][k] for k in rows[0]}
            return pd.DataFrame({k: out[k] if k in ("ids", "loss") else pd.array(out[k], "Int64") for k in out})

        return run

    chosen = [F.col("doc_id").cast("long").alias("doc_id"), *([F.col(prompt).alias("prompt")] if prompt else []), F.col(answer).alias("answer")]
    level = saved(examples.select(*chosen).mapInArrow(first, PACKED), "packed-0")
    out, depth = level.where("part is null"), 0
    parts = level.agg(F.max("part")).first()[0]
    while parts is not None:
        depth, groups = depth + 1, parts // FAN + 1
        left = level.where("part is not null").select(*[f.split()[0] for f in LEFT.split(", ")], F.floor(F.col("part") / FAN).cast("long").alias("group"))
        level = saved(left.groupBy("group").applyInPandas(merge(depth, groups == 1), PACKED), f"packed-{depth}")
        out = out.unionByName(level.where("part is null"))
        parts = None if groups == 1 else level.agg(F.max("part")).first()[0]
    return out.drop("part", "place")


def op12_packing(spark, sf_dir):
    packed = pack_examples(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
