"""BPE encoding and decoding by segment trees over adjacent pair ranks (operator 8).

Every piece of text (a word) is a row of symbols. A segment tree over its positions holds
``rank * width + position`` of the pair that starts there, so the root is the leftmost pair of
lowest rank. Merging it changes three leaves (the pair, its left neighbour, the symbol that
disappears), each a point update in logarithmic time; a word is done when the root is empty.
All new words of a batch whose trees have the same width advance together in numpy arrays, so
the Python cost is per merge step, not per word. A long word has a tree in plain integers of its
own. Words met before are looked up in a bounded
memory per Python worker.

Defined results: a null text is an empty text; it has no tokens and decodes to "". The
texts of special tokens become those tokens, as the library does by default.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
from pyspark.sql import DataFrame

from sparkrisk.llm.tokens import WS, tokenizer_kind

MAX_WORDS = 700_000
_EMPTY = int(np.iinfo(np.int64).max)
# Tree cells worked on at once.
_CELLS = 4_000_000
# From this width on a word has a tree of its own: few such words are in a batch, and then a merge
# costs less in plain integers than in numpy calls.
_LONG = 512


def _byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others follow from U+0100 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {b: chr(b) for b in keep} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class BpeModel:
    """Merge table and vocabulary of a byte-level BPE file, as numpy arrays."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.kind = tokenizer_kind(path)
        if self.kind == "other" or spec["model"].get("type") not in (None, "BPE"):
            raise ValueError(f"{path}: only byte-level BPE files are read")
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.tokens: dict[int, str] = {i: t for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens.update({i: t for t, i in self.special.items()})
        self._idstr = {i: str(i) for i in self.tokens}
        end = model.get("end_of_word_suffix") or ""
        alphabet = _byte_alphabet()
        self._symbol = np.array([vocab.get(alphabet[b], -1) for b in range(256)], dtype=np.int64)
        self._last = np.array([vocab.get(alphabet[b] + end, -1) for b in range(256)], dtype=np.int64)
        self._bytes = {c: b for b, c in alphabet.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self._width = max(self.tokens) + 1
        keys = np.array([vocab[a] * self._width + vocab[b] for a, b in pairs], dtype=np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self._keys, self._ranks, self._merged = keys[order], order.astype(np.int64), merged
        if self.kind == "word":
            pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        else:  # the fixed pattern of byte-level files
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        # Python's \s also holds four separators that the file's \s does not.
        space = f"[{WS}]"
        pattern = pattern.replace(r"[^\s", "[^" + space[1:-1]).replace(r"\s", space).replace(r"\S", "[^" + space[1:])
        self._pieces = regex.compile(pattern)
        self._space = re.compile(space + "+")
        self._find_special = re.compile("|".join(sorted(map(re.escape, self.special), key=len, reverse=True)) or r"(?!)")
        self._max = max_words
        self._known: dict[str, bytes] = {}
        self._chunks: dict[str, bytes] = {}

    # -- the segment trees --------------------------------------------------------------

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self._width + b
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        hit = (self._keys[at] == key) & (a >= 0) & (b >= 0)
        return np.where(hit, self._ranks[at], -1)

    def _merge(self, sym: np.ndarray, count: np.ndarray, width: int) -> None:
        """Merge all rows of ``sym`` (rows x width symbols, -1 beyond ``count``) in place."""
        rows, shift = len(sym), width.bit_length() - 1
        column = np.arange(width)
        live = column < count[:, None]
        nxt = np.where(column + 1 < count[:, None], column + 1, -1)
        prv = np.where(live, column - 1, -1)
        leaf = np.full((rows, width), _EMPTY)
        rank = self._pair_rank(sym[:, :-1], sym[:, 1:])
        leaf[:, :-1] = np.where(rank >= 0, (rank << shift) | column[:-1], _EMPTY)
        tree = np.full((rows, 2 * width), _EMPTY)
        tree[:, width:] = leaf
        level = width // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2
        flat, syms, nexts, prevs = tree.ravel(), sym.ravel(), nxt.ravel(), prv.ravel()

        def update(row: np.ndarray, pos: np.ndarray, value: np.ndarray) -> None:
            base, node = row * 2 * width, width + pos
            flat[base + node] = value
            for _ in range(shift):
                node = node >> 1
                flat[base + node] = np.minimum(flat[base + 2 * node], flat[base + 2 * node + 1])

        def pair(at: np.ndarray, base: np.ndarray, pos: np.ndarray) -> np.ndarray:
            right = nexts[at]
            rank = self._pair_rank(syms[at], np.where(right >= 0, syms[base + right], -1))
            return np.where(rank >= 0, (rank << shift) | pos, _EMPTY)

        row = np.nonzero(tree[:, 1] < _EMPTY)[0]
        while len(row):
            root = flat[row * 2 * width + 1]
            pos, base = root & (width - 1), row * width
            at = base + pos
            gone = nexts[at]
            after = nexts[base + gone]
            syms[at] = self._merged[root >> shift]
            syms[base + gone] = -1
            nexts[at] = after
            has = after >= 0
            prevs[(base + after)[has]] = pos[has]
            update(row, gone, np.full(len(row), _EMPTY))
            update(row, pos, pair(at, base, pos))
            left = prevs[at]
            has = left >= 0
            if has.any():
                update(row[has], left[has], pair((base + left)[has], base[has], left[has]))
            row = row[flat[row * 2 * width + 1] < _EMPTY]

    def _merge_long(self, word: bytes) -> bytes:
        """Token ids of one long word: the same tree in plain integers. An update ends at the first node
        that keeps its value, so most touch a few levels only. Flat arrays: 40 bytes a symbol."""
        size = len(word)
        shift = max(size - 1, 1).bit_length()
        width = 1 << shift
        raw = np.frombuffer(word, dtype=np.uint8)
        first = self._symbol[raw]
        first[-1] = self._last[raw[-1]]
        leaves = np.full(2 * width, _EMPTY)
        rank = self._pair_rank(first[:-1], first[1:])
        at = np.arange(size - 1)
        leaves[width : width + size - 1] = np.where(rank >= 0, (rank << shift) | at, _EMPTY)
        level = width // 2
        while level:
            leaves[level : 2 * level] = np.minimum(leaves[2 * level : 4 * level : 2], leaves[2 * level + 1 : 4 * level : 2])
            level //= 2
        tree, sym = array("q", leaves.tobytes()), array("i", first.astype(np.int32).tobytes())
        nxt = array("i", np.append(np.arange(1, size), -1).astype(np.int32).tobytes())
        prv = array("i", np.arange(-1, size - 1).astype(np.int32).tobytes())
        del leaves, first, rank, at
        ranks, merged, base, low = self._rank_of, self._merged_list, self._width, width - 1

        def update(pos: int, value: int) -> None:
            node = width + pos
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
                if tree[node] == value:
                    return
                tree[node] = value

        def pair(pos: int) -> int:
            right = nxt[pos]
            if right < 0 or sym[pos] < 0 or sym[right] < 0:
                return _EMPTY
            r = ranks.get(sym[pos] * base + sym[right], -1)
            return _EMPTY if r < 0 else r << shift | pos

        while (root := tree[1]) != _EMPTY:
            pos = root & low
            gone = nxt[pos]
            after = nxt[gone]
            sym[pos] = merged[root >> shift]
            sym[gone] = -1
            nxt[pos] = after
            if after >= 0:
                prv[after] = pos
            update(gone, _EMPTY)
            update(pos, pair(pos))
            left = prv[pos]
            if left >= 0:
                update(left, pair(left))
        ids = np.frombuffer(sym, dtype=np.int32)
        return ids[ids >= 0].astype("<u4").tobytes()

    @cached_property
    def _rank_of(self) -> dict[int, int]:
        return dict(zip(self._keys.tolist(), self._ranks.tolist()))

    @cached_property
    def _merged_list(self) -> list[int]:
        return self._merged.tolist()

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """Token ids (little-endian uint32 bytes) of each non-empty word."""
        out: list[bytes] = [b""] * len(words)
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        widths = 1 << np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64)
        for width in np.unique(widths):
            of_width = np.nonzero(widths == width)[0]
            if width >= _LONG:
                for j in of_width.tolist():
                    out[j] = self._merge_long(words[j])
                continue
            step = max(1, _CELLS // int(2 * width))
            for i in range(0, len(of_width), step):
                part = of_width[i : i + step]
                count = size[part]
                mask = np.arange(width) < count[:, None]
                raw = np.frombuffer(b"".join([words[j] for j in part]), dtype=np.uint8)
                sym = np.full((len(part), int(width)), -1, dtype=np.int64)
                sym[mask] = self._symbol[raw]
                last = (np.arange(len(part)), count - 1)
                sym[last] = self._last[raw[np.cumsum(count) - 1]]
                self._merge(sym, count, int(width))
                kept = sym >= 0
                ids = sym[kept].astype("<u4").tobytes()
                ends = np.cumsum(kept.sum(1)) * 4
                start = 0
                for j, end in zip(part.tolist(), ends.tolist()):
                    out[j] = ids[start:end]
                    start = end
        return out

    # -- texts --------------------------------------------------------------------------

    def _normal(self, text: str) -> str:
        if self.kind != "word":
            return text
        text = self._space.sub(" ", unicodedata.normalize("NFC", text))
        # Lower case character by character: the final sigma has no form of its own here.
        return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)

    def _segment(self, text: str) -> list[str]:
        return [m.group() for m in self._pieces.finditer(self._normal(text))]

    def _learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self._known]
        if len(self._known) + len(new) > self._max:
            self._known.clear()
            new = list(words)
        if new:
            self._known.update(zip(new, self.merge_words([w.encode("utf-8", "replace") for w in new])))

    def _learn_chunks(self, chunks: set[str]) -> None:
        """Chunks between white space: their words' ids in a row."""
        new = [c for c in chunks if c not in self._chunks]
        if len(self._chunks) + len(new) > self._max:
            self._chunks.clear()
            new = list(chunks)
        pieces = [self._segment(c) for c in new]
        self._learn(set().union(*pieces) if pieces else set())
        known = self._known
        self._chunks.update((c, known[p[0]] if len(p) == 1 else b"".join([known[w] for w in p]))
                            for c, p in zip(new, pieces))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each whole text."""
        rows: list[list[tuple]] = []  # per text, in order: ("ids" | "chunks" | "words", value)
        for text in texts:
            text, at, row = text or "", 0, []
            for m in self._find_special.finditer(text):
                row += [self._cut(text[at : m.start()]), ("ids", np.array([self.special[m.group()]], "<u4").tobytes())]
                at = m.end()
            row.append(self._cut(text[at:]))
            rows.append(row)
        self._learn_chunks({c for row in rows for kind, value in row if kind == "chunks" for c in value})
        chunks = self._chunks
        rows = [[("ids", b"".join(map(chunks.__getitem__, v))) if kind == "chunks" else (kind, v) for kind, v in row]
                for row in rows]
        self._learn({w for row in rows for kind, value in row if kind == "words" for w in value})
        known = self._known
        return [np.frombuffer(b"".join([v if kind == "ids" else b"".join(map(known.__getitem__, v)) for kind, v in row]),
                              dtype="<u4") for row in rows]

    def _cut(self, text: str) -> tuple:
        if self.kind == "word" and not re.search("[\x1c-\x1f]", text):
            return "chunks", text.split()
        return "words", self._segment(text)

    def decode(self, ids: list[int]) -> str:
        """The library's ``decode(ids, skip_special_tokens=False)``: token texts with a space
        between where the file has no decoder, else the tokens' bytes as UTF-8."""
        if self.kind == "word":
            return " ".join(map(self.tokens.__getitem__, ids))
        special, raw = set(self.special.values()), bytearray()
        for i in ids:
            raw += self.tokens[i].encode() if i in special else bytes(map(self._bytes.__getitem__, self.tokens[i]))
        return raw.decode("utf-8", "replace")

    def id_text(self, ids: list[int]) -> str:
        return " ".join(map(self._idstr.__getitem__, ids))


@lru_cache(maxsize=2)
def model(path: str) -> BpeModel:
    """One model per Python worker and file, kept across tasks."""
    return BpeModel(path)


def encode_decode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>, decoded string) of every whole text; narrow, no shuffle."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        m = model(path)
        for batch in batches:
            ids = m.encode(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())),
                 pa.array([m.decode(i.tolist()) for i in ids], pa.string())], names=["key", "ids", "decoded"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(
        run, f"key {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("key", key)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): ``encode_decode`` with its outputs digested
    where they are made, so that no token list leaves the task."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        m = model(path)
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "replace")).hexdigest()
        for batch in batches:
            n, ids_sha, decoded_sha = [], [], []
            for ids in m.encode(batch.column(1).to_pylist()):
                ids = ids.tolist()
                n.append(len(ids))
                ids_sha.append(sha(m.id_text(ids)))
                decoded_sha.append(sha(m.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
                names=["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(
        run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("key", key)
