"""Text to token ids with the ``tokenizers`` library, a bounded memory of pieces in front.

``TokenEncoder.encode_column(column)`` gives, for each text of an Arrow string column, the ids that
``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` gives. The UTF-8 bytes of all
texts are cut into pieces at places no token crosses: at ASCII white space, and between a letter
and ASCII punctuation (the apostrophe excepted). So a text's ids are the ids of its pieces in a
row. Pieces are hashed, made unique and looked up as whole numpy arrays; every piece is compared
byte by byte with the remembered one, so equal hashes of different pieces do no harm. What was not
met before is encoded by the library: its model alone for pieces of plain letters (normalizing and
splitting do nothing but change their case and spell them in the byte alphabet), else the whole
tokenizer. Texts with special tokens or unusual white space, and files of other kinds, are encoded
text by text.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

from sparkrisk.llm.wordhash import _BYTE, _R, _R_INV, mix, powers, utf8

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core

# Pieces remembered per Python worker, about 60 bytes each; when they are too many, the longer half
# (rarely met again) is forgotten.
MAX_PIECES = 1_200_000
# Bytes looked up at a time, and the longest piece that is remembered.
BLOCK_BYTES = 1 << 20
LONG_PIECE = 1024

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PUNCTUATION = np.zeros(256, dtype=bool)
_PUNCTUATION[[c for c in range(33, 127) if not chr(c).isalnum() and c != ord("'")]] = True
# Letters whose lower case is one letter, whatever stands around them.
_PLAIN = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+\\Z")
# White space as the tokenizers' regular expressions define it; that beyond ASCII.
WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ODD_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_ODD_LEAD = np.zeros(256, dtype=bool)
_ODD_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def tokenizer_kind(path: str) -> str:
    """"word" (white space dropped), "byte" (white space kept) or "other"."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
        return "byte"
    steps = [s.get("type") for s in (norm or {}).get("normalizers", [])]
    split = (pre.get("pretokenizers") or [{}])[0]
    if steps == ["NFC", "Replace", "Lowercase"] and split.get("type") == "Split" and split.get("invert") is True:
        return "word"
    return "other"


def _byte_letters() -> dict[int, str]:
    """The byte alphabet of byte-level files, as a table for ``str.translate``: printable bytes stand
    for themselves, the others for the code points from 256 on."""
    own = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173]
    others = [b for b in range(256) if b not in set(own)]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(others)}}


def _gather(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places ``start[i]`` to ``start[i] + count[i]``, one range after the other."""
    ends = np.cumsum(count)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + count, count)


class _Pieces:
    """Remembered pieces: hash -> bytes and ids, in arrays sorted by hash."""

    def __init__(self):
        self.hash, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)  # bytes of an entry
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)  # its ids
        self.bytes, self.ids = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint32)
        self.n_bytes = self.n_ids = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Entry of each (sorted) hash, -1 if there is none."""
        if not len(self.hash):
            return np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        return np.where(self.hash[place] == hashes, self.entry[place], -1)

    @staticmethod
    def _room(array: np.ndarray, need: int) -> np.ndarray:
        if need <= len(array):
            return array
        more = np.zeros(max(need, len(array) * 3 // 2), array.dtype)
        more[: len(array)] = array
        return more

    def add(self, hashes: np.ndarray, pieces: list[bytes], ids: list) -> np.ndarray:
        """Remember new pieces (sorted by hash); their entries."""
        own = np.arange(len(self.at), len(self.at) + len(pieces))
        size, count = np.array([len(p) for p in pieces]), np.array([len(i) for i in ids])
        self.bytes = self._room(self.bytes, self.n_bytes + int(size.sum()))
        self.ids = self._room(self.ids, self.n_ids + int(count.sum()))
        self.bytes[self.n_bytes : self.n_bytes + size.sum()] = np.frombuffer(b"".join(pieces), np.uint8)
        self.ids[self.n_ids : self.n_ids + count.sum()] = [i for part in ids for i in part]
        self.at = np.append(self.at, self.n_bytes + np.cumsum(size) - size)
        self.first = np.append(self.first, self.n_ids + np.cumsum(count) - count)
        self.size, self.count = np.append(self.size, size), np.append(self.count, count)
        self.n_bytes += int(size.sum())
        self.n_ids += int(count.sum())
        place = np.searchsorted(self.hash, hashes)
        self.hash, self.entry = np.insert(self.hash, place, hashes), np.insert(self.entry, place, own)
        return own

    def keep(self, entries: np.ndarray) -> None:
        """Forget all but ``entries`` (ascending)."""
        self.bytes = self.bytes[_gather(self.at[entries], self.size[entries])]
        self.ids = self.ids[_gather(self.first[entries], self.count[entries])]
        self.n_bytes, self.n_ids = len(self.bytes), len(self.ids)
        number = np.full(len(self.at), -1)
        number[entries] = np.arange(len(entries))
        stays = number[self.entry] >= 0
        self.hash, self.entry = self.hash[stays], number[self.entry[stays]]
        self.size, self.count = self.size[entries], self.count[entries]
        self.at, self.first = np.cumsum(self.size) - self.size, np.cumsum(self.count) - self.count


class TokenEncoder:
    def __init__(self, path: str, max_pieces: int = MAX_PIECES):
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        self._tok.no_truncation()
        self._tok.no_padding()
        self.size = self._tok.get_vocab_size(with_added_tokens=True)
        self.kind = tokenizer_kind(path)
        self._model = self._tok.model
        self._special = [t.content for t in self._tok.get_added_tokens_decoder().values()]
        self._letters = _byte_letters()
        self._max = max_pieces
        self._known = _Pieces()

    def _library(self, texts: list[str]) -> list[list[int]]:
        batch = getattr(self._tok, "encode_batch_fast", self._tok.encode_batch)
        return [e.ids for i in range(0, len(texts), 4096) for e in batch(texts[i : i + 4096], add_special_tokens=False)]

    def _spell(self, piece: str) -> str:
        """A plain piece as the model sees it."""
        text = piece.lower() if self.kind == "word" else piece
        if text.isascii():
            return text if text[0] != " " else self._letters[32] + text[1:]
        return text.encode().decode("latin-1").translate(self._letters)

    def _learn(self, pieces: list[bytes]) -> list[list[int]]:
        texts = [p.decode() for p in pieces]
        out: list = [None] * len(texts)
        rest = []
        spell, split, plain = self._spell, self._model.tokenize, _PLAIN.match
        for i, t in enumerate(texts):
            if plain(t):
                out[i] = [k.id for k in split(spell(t))]
            else:
                rest.append(i)
        for i, ids in zip(rest, self._library([texts[i] for i in rest])):
            out[i] = ids
        return out

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First byte of and byte after every piece."""
        space = _SPACE[data]
        letter = _ASCII_LETTER[data]  # or the last byte of a letter of U+00C0 to U+00FF
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[1:-1] = letter[:-1] & _PUNCTUATION[data[1:]]
        new = np.zeros(len(data) + 1, dtype=bool)  # the first byte of a text
        new[offsets] = True
        if self.kind == "word":
            edge[1:-1] |= space[:-1] != space[1:]
        else:
            after_space = space[:-1] & ~space[1:] & ~new[1:-1]
            edge[1:-1] |= after_space & (data[:-1] != 32)  # a single space belongs to the word behind it
            edge[1:-1] |= space[1:] & ~space[:-1]
            edge[:-2] |= after_space  # the last white space of a run
        edge |= new
        at = np.nonzero(edge)[0]
        start, end = at[:-1], at[1:]
        if self.kind == "word":
            words = ~space[start]
            start, end = start[words], end[words]
        return start, end

    def _block(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, ids per piece) of neighbouring pieces."""
        size, base = end - start, int(start[0])
        span = data[base : int(end[-1])]
        sums = np.zeros(len(span) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[span] * powers(_R, len(span)), out=sums[1:])
        hashes = mix((sums[end - base] - sums[start - base]) * powers(_R_INV, len(span))[start - base] + size.astype(np.uint64) * _R)
        unique, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        known = self._known
        entry = known.find(unique)
        new = np.nonzero(entry < 0)[0]
        if len(new):
            raw, where = span.tobytes(), example[new]
            pieces = [raw[a:b] for a, b in zip((start[where] - base).tolist(), (end[where] - base).tolist())]
            if len(known.at) + len(new) > self._max:
                used = np.zeros(len(known.at), dtype=bool)
                used[entry[entry >= 0]] = True
                used |= known.size < np.median(known.size) if len(known.at) > len(new) else False
                known.keep(np.nonzero(used)[0])
                entry = known.find(unique)
            entry[new] = known.add(unique[new], pieces, self._learn(pieces))
        entry = entry[which]
        same = known.size[entry] == size
        if same.all():
            same = data[_gather(start, size)] == known.bytes[_gather(known.at[entry], size)]
        if not same.all():  # different pieces with one hash
            ids = self._library([data[a:b].tobytes().decode() for a, b in zip(start, end)])
            return np.array([i for part in ids for i in part], np.uint32), np.array([len(part) for part in ids])
        count = known.count[entry]
        return known.ids[_gather(known.first[entry], count)], count

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids per text)."""
        texts = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(texts, np.int64)
        start, end = self._cut(data, offsets)
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        long = np.nonzero(end - start > LONG_PIECE)[0].tolist()
        begin = 0
        for stop in [*long, len(start)]:
            while begin < stop:
                most = min(stop, max(begin + 1, int(np.searchsorted(end, start[begin] + BLOCK_BYTES, "right"))))
                got, count = self._block(data, start[begin:most], end[begin:most])
                ids.append(got)
                counts.append(count)
                begin = most
            if stop < len(start):
                got = self._library([data[start[stop] : end[stop]].tobytes().decode()])[0]
                ids.append(np.array(got, np.uint32))
                counts.append(np.array([len(got)]))
                begin = stop + 1
        text = np.searchsorted(offsets, start, "right") - 1
        return np.concatenate(ids), np.bincount(text, np.concatenate(counts), texts).astype(np.int64)

    def _whole(self, data: np.ndarray, offsets: np.ndarray, column) -> list[int]:
        """Texts that cannot be cut as ``_cut`` does."""
        if self.kind == "other":
            return np.nonzero(np.diff(offsets))[0].tolist()
        found: set[int] = set()
        for head in {s.encode()[:2] for s in self._special}:
            at = np.nonzero((data[:-1] == head[0]) & (data[1:] == head[-1]))[0]
            rows = set((np.searchsorted(offsets, at, "right") - 1).tolist())
            found |= {r for r in rows if any(s in column[r].as_py() for s in self._special)}
        if self.kind == "byte":
            at = np.nonzero(_ODD_LEAD[data[:-1]])[0]
            lead, then = data[at], data[at + 1]
            at = at[((lead == 0xC2) & ((then == 0x85) | (then == 0xA0))) | ((lead == 0xE1) & (then == 0x9A))
                    | ((lead == 0xE2) & (then <= 0x81)) | ((lead == 0xE3) & (then == 0x80))]
            rows = set((np.searchsorted(offsets, at, "right") - 1).tolist())
            found |= {r for r in rows if _ODD_SPACE.search(column[r].as_py())}
        return sorted(found)

    def encode_column(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row as uint32, number of ids per text) of an Arrow string column; a
        null text is empty."""
        data, offsets = utf8(column)
        whole = self._whole(data, offsets, column)
        if not whole:
            return self._pieces(data, offsets)
        own = np.ones(len(offsets) - 1, dtype=bool)
        own[whole] = False
        sizes = np.diff(offsets)
        rest = data[_gather(offsets[:-1][own], sizes[own])]
        ids, counts = self._pieces(rest, np.append(0, np.cumsum(sizes[own])))
        parts, total, done, at = [], np.zeros(len(offsets) - 1, np.int64), 0, 0
        total[own] = counts
        for row, got in zip(whole, self._library([column[r].as_py() for r in whole])):
            before = int(total[done:row].sum())
            parts += [ids[at : at + before], np.array(got, np.uint32)]
            total[row], at, done = len(got), at + before, row + 1
        parts.append(ids[at:])
        return np.concatenate(parts), total

    def encode_rows(self, column) -> list[bytes]:
        """Ids of each text of an Arrow column as little-endian uint32 bytes."""
        ids, counts = self.encode_column(column)
        raw, ends = ids.astype("<u4").tobytes(), np.cumsum(counts)
        return [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), counts.tolist())]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The same for a list of texts."""
        import pyarrow as pa

        return self.encode_rows(pa.array(texts, pa.large_string()))


@lru_cache(maxsize=4)
def encoder(path: str) -> TokenEncoder:
    """One encoder per Python worker and file, kept across tasks."""
    return TokenEncoder(path)
