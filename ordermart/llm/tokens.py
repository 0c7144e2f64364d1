"""Tokenizing whole texts with a public byte-level BPE file, chunk by chunk.

The pre-tokenizer of such a vocabulary never joins a space that precedes a
non-space character to what stands before it, and a newline between two
non-space characters is a piece of its own. So a text may be cut there and
the chunks encoded apart; the ids are those of the whole text
(``tests/llm/test_tokens.py`` holds this against the plain call). Words
repeat, so a batch's distinct chunks are found first (an Arrow dictionary),
only those are encoded, and the ids are laid out by their indexes. Letters
behind at most one space, and ASCII marks after them up to the chunk's end (no
apostrophe), are single pieces of the pre-tokenizer: they go straight to the
library's BPE model, other chunks through the whole call. Nothing is kept from
batch to batch; memory is in proportion to ``BATCH_BYTES`` or the longest text.

Control strings of the vocabulary inside a text are what the library makes
of them: tokens of their own, around which the text is cut. With
``controls_as_text`` they are ordinary text.
"""

from __future__ import annotations

import codecs
import os
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, compress, count
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTE_BPE = "byte_bpe_50k.json"
SEGMENT_BYTES = 1 << 20     # a longer text is encoded in segments of about this size
PIECES = 4096               # pieces that the BPE model gets at a time
BATCH_BYTES = 16 << 20      # chunks are made distinct over about so many bytes
# on UTF-8; letters, digits and marks that are no white space, by their first byte
_CUT = re.compile(rb" (?=[!-~\xc3-\xe0\xe4-\xf4])")
# where a long segment may be cut: before a space and a word, between a letter and a digit, between an ideograph and a stop
_LONG_CUT = re.compile(rb"(?= [!-~\xc3-\xe0\xe4-\xf4])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
                       rb"|(?<=[\xe5-\xe8][\x80-\xbf][\x80-\xbf])(?=\xe3\x80[\x81\x82]|\xef\xbc\x8c)")
# white space other than space and newline: of one byte, of two or three, and what begins with the bytes of many marks
_RARE = re.compile(rb"[\t\x0b-\r\x1c-\x1f]")
_RARE_WIDE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
_RARE_MARKS = re.compile(rb"\xe2\x80[\x80-\x8a\xa8\xa9\xaf]")
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"      # ASCII punctuation but the apostrophe
_by_path: dict[tuple[str, bool], "ChunkTokenizer"] = {}


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(BYTE_BPE)


def tokenizer(path: str, controls_as_text: bool = False) -> "ChunkTokenizer":
    """This process's tokenizer for a vocabulary file; tasks that run in the
    same Python worker share it."""
    key = path, controls_as_text
    if key not in _by_path:
        _by_path[key] = ChunkTokenizer(path, controls_as_text=controls_as_text)
    return _by_path[key]


class ChunkTokenizer:
    def __init__(self, path: str, controls_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = controls_as_text
        added = [] if controls_as_text else self.model.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError("control strings that take in what stands beside them are not supported")
        longest_first = sorted((t.content for t in added), key=len, reverse=True)
        self.controls = re.compile(f"({'|'.join(map(re.escape, longest_first))})".encode()) if longest_first else None
        self.bpe = self.model.model

    def plain(self, text: str) -> list[int]:
        return self.model.encode(text, add_special_tokens=False).ids

    def encode(self, texts: Iterable[str | bytes | None]) -> Iterator[np.ndarray]:
        """The ids of each text in turn, as unsigned 32-bit integers (null:
        none). Bytes are UTF-8; what is none stands for U+FFFD."""
        todo: list[bytes] = []
        held = 0
        for text in texts:
            todo.append(text.encode() if isinstance(text, str) else text or b"")
            held += len(todo[-1])
            if held >= BATCH_BYTES:
                yield from self._encode(todo)
                todo, held = [], 0
        yield from self._encode(todo)

    def _encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        marked, owner = [], []
        for i, text in enumerate(texts):
            if b"\0" not in text:
                for part in self.controls.split(text) if self.controls else [text]:
                    for segment in _segments(part):
                        marked.append(_marked(segment))
                        owner.append(i)
        ids, ends = self._segment_ids(marked) if marked else (np.empty(0, "<u4"), np.empty(0, np.int64))
        del marked
        ends_of = np.zeros(len(texts) + 1, dtype=np.int64)
        np.maximum.at(ends_of, np.array(owner, dtype=np.int64) + 1, ends)
        ends_of = np.maximum.accumulate(ends_of)
        for i, text in enumerate(texts):
            if b"\0" in text:
                yield np.array(self.plain(text.decode("utf-8", "replace")), "<u4")
            else:
                yield ids[ends_of[i]:ends_of[i + 1]]

    def _segment_ids(self, marked: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the segments, and where each segment's ids end."""
        last = np.cumsum([m.count(b"\0") + 1 for m in marked])        # chunks up to each segment's end
        joined = b"\0".join(marked)
        marked.clear()
        text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), 1, [None, pa.py_buffer(np.array([0, len(joined)])),
                                                                       pa.py_buffer(joined)])
        coded = pc.split_pattern(text, b"\0").flatten().dictionary_encode()
        index, coded, text, joined = coded.indices.to_numpy(), coded.dictionary, None, None
        distinct = pa.ListArray.from_arrays(pa.array([0, len(coded)], pa.int32()), coded)
        chunks = pc.binary_join(distinct, pa.scalar(b"\0", pa.large_binary()))[0].as_py().decode("utf-8", "replace").split("\0")
        del coded, distinct
        flat, length = self._chunk_ids(chunks)
        del chunks
        at, ends = _laid_out(length, index)
        return flat[at], ends[last - 1]

    def _chunk_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct chunks, one after the other, and how many each has."""
        bare = "\0".join(["", *chunks]).replace("\0 ", "\0").split("\0")[1:]      # without a space in front
        word = np.fromiter(map(str.isalpha, bare), bool, len(bare))
        del bare
        pieces = dict(zip(compress(chunks, word), count()))
        parts = np.full((len(chunks), 2), -1)                       # each chunk's one or two pieces; the last has no ids
        parts[word, 0] = np.arange(len(pieces))
        other, rows, whole = np.flatnonzero(~word).tolist(), [], []
        for k in other:
            chunk = chunks[k]
            head = chunk.rstrip(_MARKS)
            first = pieces.get(head)
            if first is None and (head[1:] if head[:1] == " " else head).isalpha():
                first = pieces[head] = len(pieces)
            if first is None:
                whole.append(k)
                rows.append((-1, -1))
            else:
                rows.append((first, pieces.setdefault(chunk[len(head):], len(pieces))))
        parts[other] = np.array(rows, np.int64).reshape(-1, 2)
        spelt = codecs.charmap_decode("\0".join(pieces).encode(), "strict", _BYTE_CHARS)[0].split("\0") if pieces else []
        ids, length = array("I"), array("q")
        for k in range(0, len(spelt), PIECES):
            known = list(map(self.bpe.tokenize, spelt[k:k + PIECES]))
            ids.extend(map(_ID, chain.from_iterable(known)))
            length.extend(map(len, known))
        parts[whole, 0] = len(length) + np.arange(len(whole))
        for k in whole:
            plain = self.plain(chunks[k])
            ids.extend(plain)
            length.append(len(plain))
        length.append(0)
        at, ends = _laid_out(np.array(length), parts.reshape(-1))
        return np.array(ids, "<u4")[at], np.diff(ends[1::2], prepend=0)


def _laid_out(length: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the elements of the runs ``index`` lie, if the runs of those
    lengths lie one after the other, and where each run ends in the result."""
    start = np.cumsum(length) - length
    own = length[index]
    ends = np.cumsum(own)
    small = np.int32 if max(length.sum(), own.sum()) < 1 << 31 else np.int64
    at = np.repeat((start[index] - (ends - own)).astype(small), own)
    at += np.arange(len(at), dtype=small)
    return at, ends


def _byte_chars() -> str:
    """The character that stands for each byte in a byte-level vocabulary, by
    byte: printable Latin-1 characters stand for themselves, the others
    follow from 256 on. Byte 0 stays, as it separates pieces and is in none."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    other = [b for b in range(256) if b not in own]
    char = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(other)}
    return "\0" + "".join(char[b] for b in range(1, 256))


_BYTE_CHARS = _byte_chars()
_ID = attrgetter("id")


def _odd(text: bytes) -> bool:
    """True when the text has whitespace other than single spaces and
    newlines between other characters: it is cut before " x" only."""
    return (b"  " in text or b"\n\n" in text or b" \n" in text or b"\n " in text or text[:1] in (b"", b" ", b"\n")
            or text[-1:] in (b" ", b"\n") or any(x in text for x in _RARE_WIDE)
            or b"\xe2\x80" in text and _RARE_MARKS.search(text) is not None or _RARE.search(text) is not None)


def _marked(segment: bytes) -> bytes:
    """The segment with \\0 between the chunks that are encoded apart."""
    if _odd(segment[1:] if segment[:1] == b" " else segment):
        return segment[:1] + _CUT.sub(b"\0 ", segment[1:])
    return segment[:1] + segment[1:].replace(b" ", b"\0 ").replace(b"\n", b"\0\n\0")


def _segments(text: bytes) -> Iterator[bytes]:
    """The text in segments of about SEGMENT_BYTES bytes, cut where the
    pre-tokenizer always cuts."""
    start = 0
    while len(text) - start > SEGMENT_BYTES:
        cut = _LONG_CUT.search(text, start + SEGMENT_BYTES)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    rest = text[start:] if start else text
    if rest:
        yield rest
