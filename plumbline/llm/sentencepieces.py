"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

White space is a marker, U+2581, put before every word and before the text.  As no piece
holds the marker behind another character, the best path of a text is the best paths of its
marker-led words, so a worker looks each distinct word up once.  Characters without a piece
become the pieces of their UTF-8 bytes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
#: Kinds of pieces in a model file.
NORMAL, BYTE = 1, 6


class DoubleArray:
    """A trie over bytes: the child of node n by byte c is base[n] + c + 1 if check says n."""

    def __init__(self, keys: list[bytes], values: list[int]):
        size = 1 << 12
        base, check, value = [0] * size, [-1] * size, [-1] * size
        tree: dict = {}
        for k, v in zip(keys, values, strict=True):
            node = tree
            for c in k:
                node = node.setdefault(c, {})
            node[-1] = v
        check[0], free, hint = 0, 257, 0  # any byte can lead to place 257 and above
        todo = [(0, tree)]
        for n, node in todo:
            value[n] = node.get(-1, -1)
            kids = sorted(c for c in node if c >= 0)
            if not kids:
                continue
            while free + 300 < len(check) and check[free] >= 0:
                free += 1
            # one child fits the first free place; several look on from where a place was last found
            b, tries = free - kids[0] - 1 if len(kids) == 1 else hint, 0
            while True:
                if b + 300 > len(check):
                    base, check, value = base + [0] * len(base), check + [-1] * len(check), value + [-1] * len(value)
                if all(check[b + c + 1] < 0 for c in kids):
                    break
                b, tries = b + 1, tries + 1
            if len(kids) > 1 and tries > 50:
                hint = b
            base[n] = b
            for c in kids:
                check[b + c + 1] = n
                todo.append((b + c + 1, node[c]))
        self.base, self.check, self.value = (np.array(x, np.int32) for x in (base, check, value))


class PieceModel:
    """The pieces of a model file with log scores; small, so it can be broadcast."""

    def __init__(self, path: str, scores: str = "zipf"):
        """scores: "model" takes the file's; "zipf" makes log probabilities from the pieces' order,
        ln(1 / rank) less the ln of their sum, for files whose scores are merge ranks."""
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        self.pieces = [p.piece for p in proto.pieces]
        normal = [i for i, p in enumerate(proto.pieces) if p.type == NORMAL]
        self.bytes = [-1] * 256
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                self.bytes[int(p.piece[3:5], 16)] = i
        if any(b < 0 for b in self.bytes):
            raise ValueError("the model has no byte pieces")
        if any(MARK in self.pieces[i].lstrip(MARK) for i in normal):
            raise ValueError("a piece holds the marker behind another character")
        if scores == "zipf":
            total = math.log(sum(1 / (r + 1) for r in range(len(normal))))
            score = {i: -math.log(r + 1) - total for r, i in enumerate(normal)}
        else:
            score = {i: proto.pieces[i].score for i in normal}
        self.score = [score.get(i, 0.0) for i in range(len(self.pieces))]
        self.unknown = min(score.values(), default=0.0) - 10
        self.trie = DoubleArray([self.pieces[i].encode() for i in normal], normal)
        #: What each id decodes to, the marker as a space; none for control pieces.
        self.surface = [self.pieces[i].replace(MARK, " ").encode() if i in score else b"" for i in range(len(self.pieces))]
        for b, i in enumerate(self.bytes):
            self.surface[i] = bytes([b])
        self.is_byte = np.zeros(len(self.pieces), bool)
        self.is_byte[self.bytes] = True
        self.in_pieces = frozenset("".join(self.pieces[i] for i in normal))


class Encoder:
    """Encodes texts; lives in a worker, with a bounded cache of words."""

    CACHE = 250_000
    #: Units up to this many bytes go through the array form of the search.
    SHORT = 48

    def __init__(self, model: PieceModel):
        self.model = model
        trie = model.trie
        self.base, self.check, self.value = (x.tolist() for x in (trie.base, trie.check, trie.value))
        # places past the end belong to no node, so a step never has to look at the length
        self.arrays = trie.base, np.concatenate([trie.check, np.full(300, -2, np.int32)]), trie.value
        self.scores = np.array(model.score)
        self.words: dict[str, bytes] = {}
        # a character that no piece holds splits every path, so a line break can split words
        self.splits_lines = "\n" not in model.in_pieces
        self.line = np.array([model.bytes[10]], np.int32).tobytes()

    def viterbi(self, unit: str) -> list[int]:
        """The ids of the best path; of equal paths the one whose last piece is longest."""
        raw = unit.encode("utf-8", "replace")
        n, base, check, value = len(raw), self.base, self.check, self.value
        score, unknown = self.model.score, self.model.unknown
        low = float("-inf")
        best, start, piece = [low] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        best[0], limit = 0.0, len(check)
        for i in range(n):
            here = best[i]
            if here == low:
                continue
            c = raw[i]
            width = 1 if c < 0x80 else 2 if c < 0xE0 else 3 if c < 0xF0 else 4
            node, known = 0, False
            for j in range(i, n):
                to = base[node] + raw[j] + 1
                if to >= limit or check[to] != node:
                    break
                node = to
                v = value[node]
                if v >= 0:
                    known |= j + 1 - i == width
                    s = here + score[v]
                    if s > best[j + 1]:
                        best[j + 1], start[j + 1], piece[j + 1] = s, i, v
            if not known and here + unknown > best[i + width]:
                best[i + width], start[i + width], piece[i + width] = here + unknown, i, -1
        out, at = [], n
        while at:
            if piece[at] >= 0:
                out.append(piece[at])
            else:
                out += [self.model.bytes[b] for b in reversed(raw[start[at] : at])]
            at = start[at]
        return out[::-1]

    def search(self, units: list[bytes]) -> list[bytes | None]:
        """Best paths of many short units at once, the same as viterbi's; None if a byte is unknown.

        Position by position, every unit takes one step in the trie per array operation.
        """
        base, check, value = self.arrays
        n, size = len(units), np.array([len(u) for u in units])
        top = int(size.max())
        raw = np.frombuffer(b"".join(u.ljust(top, b"\0") for u in units), np.uint8).reshape(n, top)
        width = np.where(raw < 0x80, 1, np.where(raw < 0xE0, 2, np.where(raw < 0xF0, 3, 4)))
        best = np.full((n, top + 1), -np.inf)
        best[:, 0] = 0.0
        start, piece = np.zeros((n, top + 1), np.int16), np.zeros((n, top + 1), np.int32)
        for i in range(top):
            act = np.flatnonzero((best[:, i] > -np.inf) & (size > i))
            known = np.zeros(n, bool)
            rows, node = act, np.zeros(len(act), np.int32)
            for j in range(i, top):
                to = base[node] + raw[rows, j] + 1
                go = (check[to] == node) & (size[rows] > j)
                rows, node = rows[go], to[go]
                if not len(rows):
                    break
                v = value[node]
                at, ids = rows[v >= 0], v[v >= 0]
                known[at[width[at, i] == j + 1 - i]] = True
                s = best[at, i] + self.scores[ids]
                up = s > best[at, j + 1]
                at, ids = at[up], ids[up]
                best[at, j + 1], start[at, j + 1], piece[at, j + 1] = s[up], i, ids
            odd = act[~known[act]]
            to = i + width[odd, i]
            s = best[odd, i] + self.model.unknown
            up = s > best[odd, to]
            odd, to = odd[up], to[up]
            best[odd, to], start[odd, to], piece[odd, to] = s[up], i, -1
        rows, at, parts = np.arange(n), size.copy(), []
        while len(rows):
            parts.append((rows, piece[rows, at]))
            at = start[rows, at].astype(np.int64)
            rows, at = rows[at > 0], at[at > 0]
        who, ids = (np.concatenate([p[k] for p in parts[::-1]]) for k in (0, 1))
        order = np.argsort(who, kind="stable")
        who, ids = who[order], ids[order].astype(np.int32)
        bad = set(who[ids < 0].tolist())
        cut, flat = (4 * np.searchsorted(who, np.arange(n + 1))).tolist(), ids.tobytes()
        return [None if i in bad else flat[cut[i] : cut[i + 1]] for i in range(n)]

    def lookup(self, words: set[str]) -> dict[str, bytes]:
        """A table that holds the words: the cache, or while it is full a copy for them alone.

        Frequent words come early, so a full cache stays as it is.
        """
        new = sorted(w for w in words if w not in self.words)
        # the mark stands for the space before a word; after a line break there is none
        units = [w[1:] if w[:1] == "\n" and self.splits_lines else MARK + w for w in new]
        raw = [u.encode("utf-8", "replace") for u in units]
        got: list[bytes | None] = [None] * len(new)
        short = sorted((i for i, r in enumerate(raw) if 0 < len(r) <= self.SHORT), key=lambda i: len(raw[i]))
        for lo in range(0, len(short), 2048):
            part = short[lo : lo + 2048]
            for i, ids in zip(part, self.search([raw[i] for i in part]), strict=True):
                got[i] = ids
        for i, (w, u) in enumerate(zip(new, units, strict=True)):
            ids = got[i] if got[i] is not None else np.array(self.viterbi(u), np.int32).tobytes()
            got[i] = self.line + ids if w[:1] == "\n" and self.splits_lines else ids
        if len(self.words) + len(new) <= self.CACHE:
            self.words.update(zip(new, got, strict=True))
            return self.words
        return {w: self.words[w] for w in words if w in self.words} | dict(zip(new, got, strict=True))

    def encode_all(self, texts: list[str | None]) -> list[bytes | None]:
        """The ids of texts as packed 32-bit numbers."""
        split: list[list[str] | None] = []
        for t in texts:
            if t and self.splits_lines:
                t = t.replace("\n", " \n")
            plain = t and MARK not in t and "  " not in t and t[0] != " " and t[-1] != " "
            split.append(t.split(" ") if plain else None)
        found = self.lookup({w for s in split if s for w in s}).__getitem__
        return [b"".join(map(found, s)) if s else None if t is None else self.encode(t) for t, s in zip(texts, split, strict=True)]

    def encode(self, text: str) -> bytes:
        """The same for one text of any form."""
        if not text:
            return b""
        marked = MARK + text.replace(" ", MARK)
        return b"".join(np.array(self.viterbi(u), np.int32).tobytes() for u in re.findall(f"{MARK}+[^{MARK}]*", marked))


def decode_ids(model: PieceModel, ids: list[int]) -> str:
    """The text of ids: markers become spaces, bytes are joined, the first space goes."""
    return b"".join(map(model.surface.__getitem__, ids)).decode("utf-8", "replace").removeprefix(" ")


def sp_encode(docs: DataFrame, path: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",), scores: str = "zipf") -> DataFrame:
    """The carried columns and `ids` (array<int>) of each row of docs.

    A null text has null ids, an empty one none.  Texts of any length are encoded whole;
    a marker character in a text is taken for white space, as the format has it.
    """
    model = docs.sparkSession.sparkContext.broadcast(PieceModel(path, scores))
    out = docs.select(*[docs[c] for c in carry], docs[text].alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields[:-1]] + ["ids array<int>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = encoder.encode_all(part.column(len(carry)).to_pylist())
                sizes = [0 if r is None else len(r) // 4 for r in rows]
                flat = pa.array(np.frombuffer(b"".join(r for r in rows if r), np.int32))
                offsets = np.cumsum([0, *sizes]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets, mask=np.array([r is None for r in rows] + [False])), flat)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(carry)], ids], names=[*carry, "ids"])

    return out.mapInArrow(run, schema)


def sp_decode(encoded: DataFrame, path: str, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns, `text` of the ids and `n_byte_pieces`, how many ids are byte pieces.

    Null ids give a null text.  Ids outside the model are an error.
    """
    model = encoded.sparkSession.sparkContext.broadcast(PieceModel(path))
    out = encoded.select(*[encoded[c] for c in carry], encoded["ids"])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields[:-1]] + ["text string", "n_byte_pieces bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch, texts, n_bytes = whole.slice(lo, 256), [], []
                for x in batch.column(len(carry)):
                    ids = x.values.to_numpy(zero_copy_only=False) if x.is_valid else None
                    texts.append(None if ids is None else decode_ids(m, ids.tolist()))
                    n_bytes.append(0 if ids is None else int(m.is_byte[ids].sum()))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array(texts, pa.string()), pa.array(n_bytes, pa.int64())], names=[*carry, "text", "n_byte_pieces"])

    return out.mapInArrow(run, schema)
