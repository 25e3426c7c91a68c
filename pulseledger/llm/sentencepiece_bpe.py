"""SentencePiece encoding and decoding of merge-type (BPE) models.

Encoding finds the merge result without merging: a depth-first search takes the
longest piece at each position (Aho-Corasick reports all pieces of a word at
once), accepts it if it is compatible with the piece before it, else tries the
next shorter one, and steps back when none is left. Positions that cannot be
reached by a compatible prefix are marked in a bit field, so each fails once.
Two adjacent pieces are compatible if merging their joined characters again
gives exactly these two, which undoing their merges, latest first, decides.

That search needs pieces whose parts rank before them. Pieces of several spaces
are ranked by hand in public models, so runs of spaces are merged directly, once
per run length. Characters in no piece become byte pieces.

Defined cases: a null text is empty and encodes to the end id alone. The
normalizer must be the identity with a dummy space prefix (checked when the
model is loaded).
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import map_batches

SPACE = "▁"
# Words kept with their ids by a Python worker; the store is emptied when full.
CACHED_WORDS = 800_000
# The same where only ids are made, in steps that have no memory to spare.
CACHED_IDS = 100_000
_BASE_RANK = -1

# The library writes one U+FFFD for each byte that is not part of a character.
codecs.register_error("replace_each_byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))


class BytePairModel:
    """The pieces of a model file, with encode and decode of its own."""

    def __init__(self, path: str):
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = library.get_piece_size()
        self.pieces = [library.id_to_piece(i) for i in range(n)]
        self.unk, self.eos = library.unk_id(), library.eos_id()
        self.byte_ids = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes_of = {i: b for b, i in enumerate(self.byte_ids) if library.is_byte(i)}
        self.hidden = {i for i in range(n) if library.is_control(i)}
        self.has_bytes = len(self.bytes_of) == 256
        special = self.hidden | set(self.bytes_of) | {i for i in range(n) if library.is_unknown(i) or library.is_unused(i)}
        ordinary = [i for i in range(n) if i not in special]
        self.id_of = {self.pieces[i]: i for i in ordinary}
        self.score = {i: library.get_score(i) for i in ordinary}
        self.alphabet = {c for p in self.id_of for c in p}
        self._check(library)
        by_score = sorted(ordinary, key=lambda i: -self.score[i])
        self.rank = dict.fromkeys(ordinary, _BASE_RANK)
        ranks = {s: r for r, s in enumerate(dict.fromkeys(self.score[i] for i in by_score))}
        self.rank.update({i: ranks[self.score[i]] for i in ordinary if len(self.pieces[i]) > 1})
        self.parts = {i: self._last_merge(self.pieces[i]) for i in ordinary if not self._is_spaces(self.pieces[i])}
        self.found = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            if len(piece) > 1 and not self._is_spaces(piece):
                self.found.add_word(piece, (len(piece), i))
        self.single = {p: (1, i) for p, i in self.id_of.items() if len(p) == 1}
        self.found.make_automaton()
        # Of each piece, the next shorter piece that it starts with.
        self.shorter = {i: self._prefix(p) for p, i in self.id_of.items()}
        self._raw = [
            bytes([self.bytes_of[i]]) if i in self.bytes_of else b"" if i in self.hidden else " ⁇ ".encode()
            if i == self.unk else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)
        ]
        self._names = [str(i) for i in range(n)]
        self.words = self._word_pattern()
        self._compatible: dict[tuple[int, int], bool] = {}
        self._words = _Words(self)
        self._packed = _PackedIds(self)
        self._runs: dict[int, list[int]] = {}

    @staticmethod
    def _is_spaces(piece: str) -> bool:
        return len(piece) > 1 and not piece.strip(SPACE)

    def _word_pattern(self) -> re.Pattern:
        """Cuts a text where no piece can reach across: before a space that
        follows a character, around line feeds if no piece has one, and before
        ``marks``, characters that no piece has after a character other than a
        mark or a space."""
        pairs = {p[i : i + 2] for p in self.id_of for i in range(len(p) - 1)}
        marks = {chr(c) for c in range(33, 127) if not chr(c).isalnum()}
        while more := {a for a, b in pairs if b in marks and not (a in marks or a.isalpha() or a.isdecimal() or a == SPACE)}:
            marks |= more
        while crossing := {b for a, b in pairs if b in marks and a not in marks and a != SPACE}:
            marks -= crossing
        feed = "" if "\n" in self.alphabet else "\n"
        mark = re.escape("".join(sorted(marks)))
        rest = f"[^ {feed}{mark}]"
        with_marks = f" +[{mark}]*{rest}*|[{mark}]+{rest}*" if marks else f" +{rest}*"
        return re.compile("|".join([with_marks, f"{rest}+", *feed]))

    def _prefix(self, piece: str) -> tuple[int, int] | None:
        lengths = (n for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.id_of)
        return next(((n, self.id_of[piece[:n]]) for n in lengths), None)

    def _check(self, library) -> None:
        if any(SPACE in p.lstrip(SPACE) or re.match(f"{SPACE}{SPACE}+[^{SPACE}]", p) for p in self.id_of):
            raise ValueError("a piece crosses a word boundary")
        if not self.has_bytes or self.alphabet - set(self.id_of):
            raise ValueError("the model needs byte pieces and a piece for each of its characters")
        lowest = min((self.score[i] for p, i in self.id_of.items() if self._is_spaces(p)), default=0)
        twins = [i for p, i in self.id_of.items() if self._is_spaces(p) and len(p) == 2]
        if any(self.score[i] > lowest for i in twins):
            raise ValueError("pieces of spaces must merge after all others")
        for text, normal in (("", ""), (" a  B\tÅ", "".join([SPACE, SPACE, "a", SPACE, SPACE, "B\tÅ"]))):
            if library.normalize(text) != normal:
                raise ValueError("the normalizer must be the identity with a dummy prefix")

    def _last_merge(self, piece: str) -> tuple[int, int] | None:
        """The two parts whose merge made the piece."""
        ids = self._merge_all(piece, stop=2)
        return (ids[0], ids[1]) if len(piece) > 1 else None

    def _merge_all(self, piece: str, stop: int = 1) -> list[int]:
        """Merge by priority until ``stop`` parts are left."""
        parts = list(piece)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else len(parts)
            if i >= 0 and j < len(parts) and (joined := parts[i] + parts[j]) in self.id_of:
                heapq.heappush(heap, (-self.score[self.id_of[joined]], i, joined))

        for i in range(len(parts) - 1):
            offer(i)
        left = len(parts)
        while heap and left > stop:
            _, i, joined = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j >= len(parts) or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, ""
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            left -= 1
            offer(i)
            offer(before[i])
        return [self.id_of[p] for p in parts if p]

    def _fits(self, first: int, second: int) -> bool:
        """Whether merging the characters of both again leaves these two.

        Merges are undone, the latest first. If the parts that then touch have
        a merge that comes before the one undone, it would have been applied.
        """
        pair = (first, second)
        rank, parts = self.rank, self.parts
        a, b, limit, ok = first, second, float("inf"), True
        while True:
            joined = self.id_of.get(self.pieces[a] + self.pieces[b])
            if joined is not None and rank[joined] < limit:
                ok = False
                break
            if rank[a] == rank[b] == _BASE_RANK:
                break
            if rank[a] > rank[b]:
                # At equal rank the left merge comes first.
                limit = rank[a]
                a = parts[a][1]
            else:
                limit = rank[b] + 0.5
                b = parts[b][0]
        if len(self._compatible) > 1_000_000:
            self._compatible.clear()
        self._compatible[pair] = ok
        return ok

    def _search(self, word: str) -> list[int]:
        """Backtracking over a run of known characters."""
        n = len(word)
        longest = [self.single[c] for c in word]
        for end, match in self.found.iter(word):
            longest[end + 1 - match[0]] = match  # ends ascend, the longest is last
        open_ = (1 << (n + 1)) - 1  # bit p: position p may still be reached
        path: list = []
        shorter, compatible = self.shorter, self._compatible
        pos, match, last = 0, longest[0], -1
        while True:
            while match:
                length, piece = match
                if open_ >> (pos + length) & 1:
                    if last < 0:
                        break
                    fits = compatible.get((last, piece))
                    if fits or fits is None and self._fits(last, piece):
                        break
                match = shorter[piece]
            if match:
                path.append(match)
                last = piece
                pos += length
                if pos == n:
                    return [piece for _, piece in path]
                match = longest[pos]
            else:
                open_ &= ~(1 << pos)
                length, piece = path.pop()
                pos -= length
                match = shorter[piece]
                last = path[-1][1] if path else -1

    def _spaces(self, n: int) -> list[int]:
        if n not in self._runs:
            if len(self._runs) > 10_000:
                self._runs.clear()
            self._runs[n] = self._merge_all(SPACE * n) if n else []
        return self._runs[n]

    def encode_word(self, word: str) -> list[int]:
        """Ids of a word with its leading spaces."""
        body = word.lstrip(" ")
        n = len(word) - len(body)
        if not body:
            return self._spaces(n)
        out: list[int] = []
        text = (SPACE + body) if n else body
        known = self.alphabet
        if known.issuperset(text):
            out = self._search(text)
        else:
            run: list[str] = []
            for c in text:
                if c in known:
                    run.append(c)
                    continue
                if run:
                    out += self._search("".join(run))
                    run = []
                out += [self.byte_ids[b] for b in c.encode()]
            if run:
                out += self._search("".join(run))
        if not n:
            return out
        alone = out[0] == self.id_of[SPACE]
        return self._spaces(n) + out[1:] if alone else self._spaces(n - 1) + out

    def _split(self, text: str) -> list[str]:
        return self.words.findall(" " + text.replace(SPACE, " ")) if text else []

    def encode(self, text: str | None, add_eos: bool = True) -> list[int]:
        out: list[int] = []
        for word in self._split(text or ""):
            out += self.encode_word(word)
        return out + [self.eos] if add_eos else out

    def packed(self, text: str) -> bytes:
        """The ids of ``encode``, four bytes each."""
        if len(self._packed) > CACHED_IDS:
            self._packed.clear()
        ids = b"".join(map(self._packed.__getitem__, self._split(text)))
        return ids + np.int32(self.eos).tobytes()

    def decode_bytes(self, ids) -> bytes:
        """Piece texts one after the other; control pieces are empty."""
        return b"".join([self._raw[i] for i in ids])

    def decode(self, ids) -> str:
        """Text of ids; the dummy prefix goes, invalid bytes become U+FFFD."""
        ids = list(ids)
        out, run = [], bytearray()
        for i in ids:
            if i in self.bytes_of:
                run.append(self.bytes_of[i])
                continue
            out += [run.decode("utf-8", "replace_each_byte"), self._raw[i].decode()]
            run.clear()
        text = "".join(out) + run.decode("utf-8", "replace_each_byte")
        first = next((i for i in ids if i not in self.hidden), None)
        starts_with_space = first is not None and first not in self.bytes_of and self.pieces[first].startswith(SPACE)
        return text[1:] if starts_with_space else text

    def round_trip(self, text: str) -> tuple[int, str, str]:
        """(number of ids with the end id, ids as text, text decoded from the ids)."""
        words = self._split(text)
        known = self._words
        if len(known) > CACHED_WORDS:
            known.clear()
        found = list(map(known.__getitem__, words))
        ids = " ".join([*[f[0] for f in found], str(self.eos)])
        # Ids of a word decode by themselves: no character is cut by a word's end.
        back = b"".join([f[1] for f in found]).decode("utf-8", "replace_each_byte")
        first = int(ids.split(" ", 1)[0])
        starts_with_space = first not in self.hidden and first not in self.bytes_of and self.pieces[first].startswith(SPACE)
        return ids.count(" ") + 1, ids, back[1:] if starts_with_space else back


class _Words(dict):
    """Words with their ids as text and what these ids decode to, each made when first seen."""

    def __init__(self, model: BytePairModel):
        self.model = model

    def __missing__(self, word: str) -> tuple[str, bytes]:
        model = self.model
        ids = model.encode_word(word)
        found = " ".join([model._names[i] for i in ids]), model.decode_bytes(ids)
        if len(word) <= 64:
            self[word] = found
        return found


class _PackedIds(dict):
    """Words with their ids as bytes, made when first seen."""

    def __init__(self, model: BytePairModel):
        self.model = model

    def __missing__(self, word: str) -> bytes:
        found = np.array(self.model.encode_word(word), np.int32).tobytes()
        if len(word) <= 64:
            self[word] = found
        return found


@lru_cache(maxsize=2)
def load(path: str) -> BytePairModel:
    """The model of a file, once per worker process."""
    return BytePairModel(path)


def with_ids(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) with the end id."""

    def run(batch: pa.RecordBatch) -> dict:
        m = load(model)
        ids = [m.packed(t.as_py() or "") for t in batch.column(1)]
        ends = np.cumsum([0, *(len(i) // 4 for i in ids)], dtype=np.int32)
        return {"id": batch.column(0), "ids": pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(ids), np.int32))}

    rows = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS id", f"`{text_col}` AS text")
    return map_batches(rows, run, "id long, ids array<int>")


def decoded(ids: DataFrame, model: str) -> DataFrame:
    """(id, text) of (id, ids); null ids give the empty text."""

    def run(batch: pa.RecordBatch) -> dict:
        m = load(model)
        return {"id": batch.column(0), "text": [m.decode(i or []) for i in batch.column(1).to_pylist()]}

    return map_batches(ids.select("id", "ids"), run, "id long, text string")


def round_trips(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every text: id, n_tokens, ids_sha256, decoded_sha256."""

    def sha(data: bytes) -> str:
        return hashlib.sha256(data).hexdigest()

    def run(batch: pa.RecordBatch) -> dict:
        m = load(model)
        n, ids, texts = [], [], []
        for text in batch.column(1).to_pylist():
            count, joined, back = m.round_trip(text or "")
            n.append(count)
            ids.append(sha(joined.encode()))
            texts.append(sha(back.encode()))
        return {"id": batch.column(0), "n_tokens": n, "ids_sha256": ids, "decoded_sha256": texts}

    rows = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS id", f"`{text_col}` AS text")
    return map_batches(rows, run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
