"""Merge-type piece encoding by backtracking, and decoding.

A text is a sequence of pieces.  Merging (best score first, leftmost on ties) gives one
sequence, and a sequence is that one exactly if re-merging every two neighbours returns the
two.  So the encoder walks through the text with the longest piece that an Aho-Corasick scan
found at a position, checks it against the piece before, tries the next shorter one, and goes
back a piece when none is left; a bit for each position records that it failed, for a prefix
has one encoding only and needs no second try.

Text is cut where no piece of the model spans the two characters, which no merge crosses.
The parts are mostly words: results are kept in a bounded memo, and the words that it lacks
are walked through side by side, one array element each.  Parts of over ``LONG`` characters
are walked through alone, the scan opening one window after the other.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.llm.common import Recent, resident

SPACE = "▁"
#: Piece types of the model file format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SCAN, KEEP, LONG, BATCH_CHARS = 4096, 150_000, 64, 1_000_000
#: Slots of the table of checked pairs, and the shift of a token in a pair's key.
SLOTS, SHIFT = 1 << 20, 22


class Matches:
    """Lengths of the pieces that start at each position, longest first; long texts are scanned in windows."""

    def __init__(self, model: Model, text: str):
        self.model, self.text, self.windows = model, text, {}

    def at(self, position: int) -> list[int]:
        k, i = divmod(position, SCAN)
        if k not in self.windows:
            if len(self.windows) > 3:
                self.windows.pop(next(iter(self.windows)))
            self.windows[k] = self._scan(k * SCAN)
        return self.windows[k][i]

    def _scan(self, begin: int) -> list[list[int]]:
        size = min(SCAN, len(self.text) - begin)
        found: list[list[int]] = [[1] for _ in range(size)]
        part = self.text[begin : begin + size + self.model.longest - 1]
        size_of = self.model.length
        for end, i in self.model.automaton.iter(part) if len(self.model.automaton) else ():
            length = int(size_of[i])
            start = end - length + 1
            if start < size:
                found[start].append(length)  # ends ascend, and so do the lengths at a start
        for x in found:
            x.reverse()
        return found


class Model:
    """A merge-type model with byte fallback and no character map, read from the bytes of its file."""

    def __init__(self, blob: bytes):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(blob)
        normal, trainer = proto.normalizer_spec, proto.trainer_spec
        if trainer.model_type != trainer.BPE or normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces:
            raise ValueError("only merge-type models without a character map or white space removal")
        self.prefix = normal.add_dummy_prefix
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes: dict[int, int] = {}
        self.unknown = 0
        self.surface: list[bytes] = []
        self.kind: list[int] = []
        for i, p in enumerate(proto.pieces):
            surface = p.piece.replace(SPACE, " ").encode()
            if p.type in (USER, UNUSED):
                raise ValueError("user-defined and unused pieces are not supported")
            if p.type == NORMAL:
                self.ids[p.piece], self.score[p.piece] = i, p.score
            elif p.type == BYTE:
                self.bytes[int(p.piece[1:-1], 16)] = i
                surface = bytes([int(p.piece[1:-1], 16)])
            elif p.type == UNKNOWN:
                self.unknown, surface = i, trainer.unk_surface.encode()
            else:
                surface = b""
            self.surface.append(surface)
            self.kind.append(p.type)
        self.controls = {i for i, k in enumerate(self.kind) if k == CONTROL}
        self.longest = max(map(len, self.ids), default=1)
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if len(piece) > 1:
                self.automaton.add_word(piece, i)
        if len(self.automaton):
            self.automaton.make_automaton()
        spans = any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        self.by_word = self.prefix and not spans
        self.cut = re.compile(".+" if spans else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", re.S)
        self.pairs = Recent(lambda ab: self.merged(ab[0] + ab[1]) == [x for x in ab if x], KEEP)
        self._tables([p.piece if p.type == NORMAL else "" for p in proto.pieces])
        self.memo: tuple[dict, dict] = {}, {}

    def merged(self, text: str) -> list[str]:
        """The merges themselves, for a text of a piece or two."""
        symbols, score = list(text), self.score
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text by backtracking over the longest matches."""
        n, matches = len(text), Matches(self, text)
        failed = bytearray(n // 8 + 1)
        out: list[str] = []
        tried: list[int] = []  # which of the matches each piece is
        position = k = 0
        while position < n:
            lengths = matches.at(position)
            while k < len(lengths):
                end = position + lengths[k]
                piece = text[position:end]
                if not failed[end >> 3] >> (end & 7) & 1 and self.pairs[out[-1] if out else "", piece]:
                    break
                k += 1
            if k < len(lengths):
                out.append(piece)
                tried.append(k)
                position, k = end, 0
            else:
                failed[position >> 3] |= 1 << (position & 7)
                position -= len(out.pop())
                k = tried.pop() + 1
        return out

    def _tables(self, pieces: list[str]) -> None:
        """Arrays over tokens: the id of a piece, or their number plus the code point of a character without one."""
        self.size = len(pieces)
        self.text_of = pieces
        alphabet = {c for p in self.ids for c in p}
        self.gap = next(c for c in map(chr, range(0x110000)) if c not in alphabet)
        self.length = np.array([len(p) or 1 for p in pieces], np.int64)
        self.single = np.arange(self.size, self.size + 0x110000)  # the token of a character alone
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.single[ord(piece)] = i
        self.shorter = np.full(self.size, -1, np.int64)
        for piece, i in self.ids.items():
            for n in range(len(piece) - 1, 0, -1):
                if n == 1 or piece[:n] in self.ids:
                    self.shorter[i] = self.ids.get(piece[:n], self.size + ord(piece[0]))
                    break
        self.slot_keys = np.full(SLOTS, -1, np.int64)
        self.slot_values = np.zeros(SLOTS, bool)

    def _token(self, i: int) -> str:
        return "" if i < 0 else self.text_of[i] if i < self.size else chr(i - self.size)

    def _agree(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For each pair of tokens (left: -1 for none), whether re-merging returns the two."""
        key = (left + 1 << SHIFT) | right
        slot = (key * 0x9E3779B97F4A7C1) >> 24 & SLOTS - 1
        new = np.flatnonzero(self.slot_keys[slot] != key)
        out = self.slot_values[slot]
        if len(new):
            keys, back = np.unique(key[new], return_inverse=True)
            pairs = self.pairs
            values = np.array([pairs[self._token((k >> SHIFT) - 1), self._token(k & (1 << SHIFT) - 1)] for k in keys.tolist()], bool)
            out[new] = values[back]
            slots = slot[new]
            self.slot_keys[slots], self.slot_values[slots] = key[new], values[back]
        return out

    def _side_by_side(self, parts: list[str]) -> list[bytes]:
        """Ids of many short parts: what ``pieces`` does, for all of them at each step."""
        text = self.gap.join(parts)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        first = self.single[codes]  # the longest piece from each position
        hits = np.fromiter(chain.from_iterable(self.automaton.iter(text) if len(self.automaton) else ()), np.int64).reshape(-1, 2)
        first[hits[:, 0] - self.length[hits[:, 1]] + 1] = hits[:, 1]  # ends ascend: the longest is written last
        n = np.fromiter(map(len, parts), np.int64, len(parts))
        start = np.cumsum(n + 1) - n - 1
        stop = start + n
        failed = np.zeros(len(text) + 1, bool)
        token = np.full(len(text) + 1, -1, np.int64)  # the token that begins there
        begin = np.zeros(len(text) + 1, np.int64)  # of the token that ends there
        lane, at, last, want = np.arange(len(parts)), start.copy(), np.full(len(parts), -1, np.int64), first[start]
        while len(lane):
            none = want < 0
            piece = want < self.size
            end = at + np.where(piece, self.length[np.where(piece & ~none, want, 0)], 1)
            fits = ~none & ~failed[end]
            fits[fits] = self._agree(last[fits], want[fits])
            token[at[fits]], begin[end[fits]] = want[fits], at[fits]
            more = ~fits & ~none & piece
            less = np.where(more, self.shorter[np.where(more, want, 0)], -1)
            stuck = ~fits & (less < 0)
            where = at[stuck]
            failed[where] = True
            back = begin[where]
            gone = token[back]
            token[back] = -1
            kept = gone < self.size
            at[stuck] = back
            last[stuck] = np.where(back == start[lane[stuck]], -1, token[begin[back]])
            less[stuck] = np.where(kept, self.shorter[np.where(kept, gone, 0)], -1)
            last[fits], at[fits] = want[fits], end[fits]
            less[fits] = first[np.minimum(at[fits], len(text) - 1)]
            going = at < stop[lane]
            lane, at, last, want = lane[going], at[going], last[going], less[going]
        ids = token[token >= 0].astype(np.int32)
        ends = np.cumsum(token >= 0)[stop - 1]
        rare = np.add.reduceat(ids >= self.size, np.concatenate([[0], ends[:-1]])).astype(bool)
        data, ends = ids.tobytes(), (4 * ends).tolist()
        out = [data[a:b] for a, b in zip([0, *ends], ends)]
        for i in np.flatnonzero(rare).tolist():
            out[i] = self._with_bytes(np.frombuffer(out[i], np.int32).tolist())
        return out

    def _with_bytes(self, tokens: list[int]) -> bytes:
        ids = array("i")
        for i in tokens:
            if i < self.size:
                ids.append(i)
            else:
                ids.extend(self.bytes.get(b, self.unknown) for b in chr(i - self.size).encode())
        return ids.tobytes()

    def _long(self, part: str) -> bytes:
        return self._with_bytes([self.ids.get(p, self.size + ord(p[0])) for p in self.pieces(part)])

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's end."""
        data: list[bytes] = []
        a = 0
        while a < len(texts):
            cut, chars = [], 0
            while a < len(texts) and (not cut or chars < BATCH_CHARS):
                text = texts[a] or ""
                chars += len(text)
                cut.append(self._cut(text))
                a += 1
            ids = self._solved(set(chain.from_iterable(cut)))
            data += [b"".join(map(ids.__getitem__, parts)) for parts in cut]
        ends = np.cumsum([len(x) // 4 for x in data], dtype=np.int64)
        return np.frombuffer(b"".join(data), np.int32), ends

    def _cut(self, text: str) -> list[str]:
        """Keys of a text's parts: a word stands for itself after one space, a space for the part that follows it."""
        if not text:
            return []
        words = text.split(" ")
        if self.by_word and SPACE not in text and "" not in words:
            return words
        parts = self.cut.findall((SPACE if self.prefix else "") + text.replace(" ", SPACE))
        return [p[1:] if p[0] == SPACE and p[1:2] not in ("", SPACE) and self.by_word else " " + p for p in parts]

    @staticmethod
    def _part(key: str) -> str:
        return key[1:] if key[0] == " " else SPACE + key

    def _solved(self, parts: set[str]) -> dict[str, bytes]:
        """Ids of each part as 32-bit numbers; the memo keeps two generations of at most ``KEEP`` parts."""
        new, old = self.memo
        here: dict[str, bytes] = {}
        missing = []
        for part in parts:
            got = new.get(part)
            if got is None:
                got = old.get(part)
                if got is None:
                    if len(part) <= LONG:
                        missing.append(part)
                    else:
                        here[part] = self._long(self._part(part))
                    continue
                new[part] = got
            here[part] = got
        if missing:
            solved = dict(zip(missing, self._side_by_side([self._part(p) for p in missing]), strict=True))
            here.update(solved)
            new.update(solved)
        if len(new) > KEEP:
            self.memo = ({}, new) if len(new) <= 2 * KEEP else ({}, {})
        return here

    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def decode(self, ids) -> str:
        """Text of ids: pieces with spaces, runs of byte pieces as UTF-8 with a replacement for each invalid byte."""
        if not self.controls.isdisjoint(ids):
            return self._decode_runs(ids)
        surface = self.surface
        data = b"".join([surface[i] for i in ids])
        if self.prefix and len(ids) and self.kind[ids[0]] == NORMAL and data[:1] == b" ":
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return self._decode_runs(ids)

    def _decode_runs(self, ids) -> str:
        out: list[str] = []
        run = bytearray()
        begun = False
        for i in [*ids, -1]:
            if i >= 0 and self.kind[i] == BYTE:
                run += self.surface[i]
                continue
            out += [c if not 0xDC80 <= ord(c) <= 0xDCFF else "�" for c in run.decode(errors="surrogateescape")]
            begun |= bool(run)
            run.clear()
            if i >= 0:
                s = self.surface[i].decode()
                if not begun and self.kind[i] == NORMAL and self.prefix and s[:1] == " ":
                    s = s[1:]
                    begun = True
                begun |= bool(s)
                out.append(s)
        return "".join(out)


def load(blob: bytes) -> Model:
    """One model for each Python worker and file."""
    return resident(("pieces", hashlib.sha256(blob).digest()), lambda: Model(blob))


def _blob(model_path: str) -> bytes:
    """The vocabulary file, read once by the driver and sent along; a few hundred kilobytes for any size of input."""
    with open(model_path, "rb") as f:
        blob = f.read()
    if len(blob) > 64 << 20:
        raise ValueError("a vocabulary file of over 64 MB is not one")
    return blob


def encoder(model_path: str):
    """Column function text -> array<int>."""
    blob = _blob(model_path)

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        model = load(blob)
        ids, ends = model.encode_batch(texts.to_pylist())
        at = np.concatenate([[0], ends]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(at), pa.array(ids))

    return encode


def decoder(model_path: str):
    """Column function array<int> -> text."""
    blob = _blob(model_path)

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        model = load(blob)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        out, at = [], 0
        for n in lists.value_lengths().fill_null(0).to_pylist():
            out.append(model.decode(flat[at : at + n].tolist()))
            at += n
        return pa.array(out, pa.string())

    return decode


def encode(df: DataFrame, model_path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the ids of every whole text, without begin or end ids.

    A null or empty text has no ids.  Repeated rows each get theirs; a column already named
    ``out`` is replaced and all others stay.  Literal piece names such as ``<s>`` are ordinary
    text.  Long texts without spaces are scanned in windows and cost time in proportion.
    """
    return df.withColumn(out, encoder(model_path)(F.col(text)))


def decode(df: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of a list of ids; null or empty lists give the empty text."""
    return df.withColumn(out, decoder(model_path)(F.col(ids)))


def digested(df: DataFrame, model_path: str, ids: str) -> DataFrame:
    """Add ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of a column of ids."""
    decoded = decode(df, model_path, ids, "_decoded")
    sha = {name: F.sha2(c.cast("binary"), 256) for name, c in (("ids_sha256", F.array_join(ids, ",")), ("decoded_sha256", F.col("_decoded")))}
    return decoded.withColumns({"n_tokens": F.size(ids).cast("long"), **sha}).drop("_decoded")


def digest(df: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """The digests of every row's ids in place of its text."""
    return digested(encode(df, model_path, text, "_ids"), model_path, "_ids").drop("_ids", text)
