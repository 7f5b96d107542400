"""SentencePiece encoding by a shared-prefix Viterbi search, and decoding.

The best segmentation of a text into the vocabulary's pieces is the one with the
largest sum of piece scores; of equal sums the one with the longer last piece.
A space is the mark U+2581, and a text gets one mark ahead of it.  No piece of the
vocabulary goes on behind a mark with other signs before it, or across a line break,
so a text falls into marked words (marks, then other signs) that are segmented one
by one.

Signs at the end of a word that no piece joins to the letters before them are cut
off first, since the search would part them anyway.  A task sorts the distinct words that are new to it.  Sorted words are a trie read
depth-first: two neighbours share the forward scores of their common prefix, which
stay on a stack, and only the rest of each word is searched.  The search goes from
each end backwards through a trie of reversed pieces, so it tries no substring that
is not the end of a piece.  A sign without a piece of its own is written as its
UTF-8 bytes (byte pieces); so is a literal U+2581, which keeps it apart from spaces.
Decoding joins the pieces' bytes and drops the first mark, and so restores every
text exactly.

The vocabulary is a file of a public tokenizer, given by path; it is read, never
trained.  Null and empty texts have no pieces and decode to the empty text.  An
empty table gives an empty result; other columns pass through, and those that bear
the name of a result column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlark.llm.texts import batches_of

MARK = "▁"
LITERAL = "\udc81"  # stands for a literal mark inside a task; no text can hold it
CACHE_WORDS = 250_000
BLOCK_BYTES = 2 << 20
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_END = ""


class Vocabulary:
    """Pieces, scores and the search over them."""

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: list[int], byte_score: float):
        """``pieces``: (piece, score) by id; an empty piece is none.  ``byte_ids``: the 256 byte pieces."""
        self.byte_ids, self.byte_score = byte_ids, byte_score
        self.bytes_of = [p.replace(MARK, " ").encode() for p, _ in pieces]
        for value, i in enumerate(byte_ids):
            self.bytes_of[i] = bytes([value])
        self.back: dict = {}
        for i, (piece, score) in enumerate(pieces):
            if piece:
                node = self.back
                for sign in reversed(piece):
                    node = node.setdefault(sign, {})
                node[_END] = (score, i)
        inner = [p for p, _ in pieces if MARK in p.lstrip(MARK) or "\n" in p[1:] or "\n" in p[:-1]]
        if inner:
            raise ValueError(f"pieces that cross words: {inner[:3]}")
        self.joined = {p[i : i + 2] for p, _ in pieces for i in range(len(p) - 1)}
        self.as_bytes = [np.int32(i).tobytes() for i in range(len(pieces))]
        self.known: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        bytes_ = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        own = [not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in ids]
        pieces = [(model.id_to_piece(i) if own[i] else "", model.get_score(i)) for i in ids]
        least = min(s for (p, s) in pieces if p)
        # A byte costs more than any piece, so bytes are used for signs without a piece only.
        return cls(pieces, bytes_, min(least, -1.0) * 64)

    def segment(self, words: list[str]) -> Iterator[tuple[str, list[int]]]:
        """Best segmentations of sorted words."""
        # Of each end on the stack: best score, place where the last piece begins, the piece (or its bytes).
        best, came, last = [0.0], [0], [0]
        before = ""
        root = self.back
        for word in words:
            n, shared = len(word), 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], came[shared + 1 :], last[shared + 1 :]
            for end in range(shared + 1, n + 1):
                score, start, piece = None, 0, 0
                node, at = root, end
                while at:
                    at -= 1
                    node = node.get(word[at])
                    if node is None:
                        break
                    if _END in node:
                        own, i = node[_END]
                        own += best[at]
                        if score is None or own >= score:
                            score, start, piece = own, at, i
                sign = word[end - 1]
                if _END not in root.get(sign, ()):  # no piece of its own
                    raw = (MARK if sign == LITERAL else sign).encode("utf-8", "replace")
                    own = best[end - 1] + self.byte_score * len(raw)
                    if score is None or own > score:
                        score, start, piece = own, end - 1, [self.byte_ids[b] for b in raw]
                best.append(score)
                came.append(start)
                last.append(piece)
            ids: list[int] = []
            at = n
            while at:
                piece = last[at]
                if isinstance(piece, int):
                    ids.append(piece)
                else:
                    ids.extend(reversed(piece))
                at = came[at]
            ids.reverse()
            yield word, ids
            before = word

    def _words(self, line: str, first: bool) -> list[str]:
        """Marked words of a line; the first line of a text gets the mark ahead of it."""
        parts = line.split(" ")
        if "" in parts:  # spaces in a row, or at an end
            marked = (MARK if first else "") + line.replace(" ", MARK)
            return _WORDS.findall(marked)
        words = [MARK + w for w in parts]
        if not first:
            words[0] = parts[0]
        return words

    def encode_all(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text."""
        split = []
        for text in texts:
            lines = text.decode("utf-8", "replace").replace(MARK, LITERAL).split("\n") if text else []
            split.append([self._words(line, i == 0) for i, line in enumerate(lines)])
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        new = set()
        for lines in split:
            for words in lines:
                new.update(words)
        new.difference_update(known)
        # A sign at the end that no piece joins to the one before it is a word of its own.
        cut = {w: w[:-1] for w in new if len(w) > 1 and w[-2:] not in self.joined}
        search = {w for w in new if w not in cut}
        search.update(c for c in cut.values() if c not in known)
        search.update(w[-1] for w in cut if w[-1] not in known)
        search.add("\n")
        for word, ids in self.segment(sorted(search)):
            known[word] = b"".join([self.as_bytes[i] for i in ids])
        for word, core in cut.items():
            known[word] = known[core] + known[word[-1]]
        between = known["\n"]
        return [
            np.frombuffer(between.join(b"".join(map(known.__getitem__, words)) for words in lines), np.int32)
            for lines in split
        ]

    def decode(self, ids) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids))
        return text[1:].decode("utf-8", "replace")


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One vocabulary for each worker process and file."""
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary.load(path)
    return _vocabularies[path]


def _with(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])


def _joined(pieces: Vocabulary, rows: pa.ListArray) -> pa.Array:
    """Texts of lists of ids."""
    texts = list(map(pieces.bytes_of.__getitem__, rows.flatten().to_numpy().tolist()))
    ends = np.cumsum(rows.value_lengths().to_numpy(zero_copy_only=False)).tolist()
    whole = [b"".join(texts[a:b])[1:] for a, b in zip([0, *ends], ends, strict=False)]
    return pa.array([w.decode("utf-8", "replace") for w in whole], pa.string())


def _encode(path: str, decoded: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(path)
        for batch in batches:
            for part, texts in batches_of(batch, limit=BLOCK_BYTES):
                ids = pieces.encode_all(texts)
                places = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(places), pa.array(values))
                part = _with(part, "pieces", lists)
                yield _with(part, "decoded", _joined(pieces, lists)) if decoded else part

    return encode


def _decode(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(path)
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index("pieces")).fill_null([])
            yield _with(batch, "decoded", _joined(pieces, rows))

    return decode


def encode(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """All columns of ``docs`` and pieces, the ids of the text; on request with decoded, the text of the ids."""
    docs = docs.drop("pieces", "decoded") if decoded else docs.drop("pieces")
    added = [T.StructField("pieces", T.ArrayType(T.IntegerType()))]
    added += [T.StructField("decoded", T.StringType())] if decoded else []
    return docs.mapInArrow(_encode(path, decoded), T.StructType([*docs.schema.fields, *added]))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """All columns of ``encoded`` (pieces, ...) and decoded, the text."""
    encoded = encoded.drop("decoded")
    return encoded.mapInArrow(_decode(path), T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))

