"""Token ids of whole texts with a public byte-level BPE vocabulary.

The vocabulary cuts a text into words before it merges bytes, so the ids of a
*piece* (what stands between two spaces or line feeds, with the one before it) do not
depend on its neighbours, and neither do those of the punctuation that ends it.
Arrow cuts a batch of texts into pieces and finds the distinct ones; the
library encodes those that the worker's bounded cache lacks; Arrow lays the ids
out by text. Texts where white space meets white space in ways that the cut
does not keep, or that hold the special token's string, are encoded as a whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 0
#: Bytes of text that are encoded at once.
ENCODE_BYTES = 1 << 23
#: Pieces that a worker remembers (about 50 bytes each). Beyond, it keeps those of its last texts.
CACHE_PIECES = 1_000_000
#: Longer pieces are encoded each time.
CACHE_PIECE_BYTES = 64
#: Pieces the library gets in one string.
JOINED = 50
# What keeps a text whole: a space before white space or the end; a line feed after or before other
# white space but a space; two line feeds before white space or the end; white space that
# libraries see differently; the special token.
_OTHER = r"\t\x0b\x0c\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WHOLE = rf" ([ \n{_OTHER}]|$)|[{_OTHER}]\n|\n[{_OTHER}]|\n\n([ \n]|$)|[\x1c-\x1f]|<\|endoftext\|>"
# Marks a text's first piece, before which nothing stands.
_FIRST = "\x1e"
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_WHOLE_PY = re.compile(r" (\s|$)|[\x1c-\x1f]|<\|endoftext\|>")
#: A longer text is encoded in parts.
LONG_CHARS = 1 << 22
_ENCODERS: dict[str, "Encoder"] = {}


def _parts(text: str) -> Iterator[str]:
    start = 0
    for at in range(LONG_CHARS, len(text), LONG_CHARS):
        cut = text.find(" ", max(at, start + 1))
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.line = self.whole(["\n"])[0][0]
        self.pieces, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, words: list[str], lead: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words without line feeds, each after ``lead`` (nothing or a space), end to end, and how many each has. The
        library gets them joined by line feeds (a run of the line feed and a space leaves the space to the word);
        they are split again at the line feed's id."""
        groups = [words[i:i + JOINED] for i in range(0, len(words), JOINED)]
        coded = self.whole([lead + f"\n{lead}".join(g) for g in groups])
        flat = np.concatenate(coded)
        group = np.repeat(np.arange(len(groups)), [len(x) for x in coded])
        between = flat == self.line
        if (np.bincount(group[between], minlength=len(groups)) != [len(g) - 1 for g in groups]).any():
            coded = self.whole([lead + w for w in words])
            return np.concatenate(coded), np.array([len(x) for x in coded])
        word = (np.cumsum(between) + group)[~between]
        return flat[~between], np.bincount(word, minlength=len(words))

    def _learn(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces as bytes. A piece stands after a space, after a line feed that it starts with, or first in its text."""
        line, first = pc.starts_with(pieces, "\n"), pc.starts_with(pieces, _FIRST)
        rest = pc.if_else(pc.or_(line, first), pc.utf8_slice_codeunits(pieces, 1), pieces)
        plain = pc.and_(pc.greater(pc.binary_length(rest), 0), pc.invert(pc.match_substring(rest, "\n")))
        line, first, plain = (x.to_numpy(zero_copy_only=False) for x in (line, first, plain))
        bare = line | first
        ids, lens, order = [], [], []
        for mine, lead in ((plain & ~bare, " "), (plain & bare, "")):
            rows = np.flatnonzero(mine)
            if len(rows):
                got, size = self._joined(rest.take(pa.array(rows)).to_pylist(), lead)
                ids.append(got)
                lens.append(size)
                order.append(rows)
        rows = np.flatnonzero(~plain)
        if len(rows):
            words = rest.take(pa.array(rows)).to_pylist()
            coded = self.whole([w if b else " " + w for w, b in zip(words, bare[rows])])
            ids += coded
            lens.append(np.array([len(x) for x in coded]))
            order.append(rows)
        starts = np.concatenate(([0], np.cumsum(np.concatenate(lens)))) * 4
        data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(pieces), [
            None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(np.concatenate(ids).astype("<u4"))])
        place = np.empty(len(pieces), dtype=np.int64)
        place[np.concatenate(order)] = np.arange(len(pieces))
        data = data.take(pa.array(place))
        if not line.any():
            return data
        feed = pa.scalar(np.array([self.line], dtype="<u4").tobytes(), pa.large_binary())
        return pc.if_else(pa.array(line), pc.binary_join_element_wise(feed, data, pa.scalar(b"", pa.large_binary())), data)

    def _known(self, pieces: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(ids of pieces as bytes, where those of each given distinct piece stand)."""
        at = pc.index_in(pieces, value_set=self.pieces)
        lost = at.is_null()
        new = pieces.filter(lost)
        if not len(new):
            return self.ids, np.asarray(at, dtype=np.int64)
        ids = pa.concat_arrays([self.ids, self._learn(new)])
        lost = lost.to_numpy(zero_copy_only=False)
        place = np.asarray(pc.fill_null(at, 0), dtype=np.int64)
        place[lost] = len(self.pieces) + np.arange(len(new))
        short = pc.less_equal(pc.binary_length(new), CACHE_PIECE_BYTES)
        if len(self.pieces) + len(new) <= CACHE_PIECES:
            if pc.all(short).as_py():
                self.ids, self.pieces = ids, pa.concat_arrays([self.pieces, new])
            else:
                fresh = ids.slice(len(self.pieces)).filter(short)
                self.ids = pa.concat_arrays([self.ids, fresh])
                self.pieces = pa.concat_arrays([self.pieces, new.filter(short)])
        else:
            short = pc.less_equal(pc.binary_length(pieces), CACHE_PIECE_BYTES)
            self.pieces, self.ids = pieces.filter(short), ids.take(pa.array(place)).filter(short)
        return ids, place

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, where each text's ids begin and the last end);
        NULL has none. A very long text goes part by part, cut before single spaces."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if len(texts) != 1 or len(text := texts[0].as_py()) <= LONG_CHARS:
            return self._encode(texts)
        if _WHOLE_PY.search(text):
            ids = self.whole([text])[0]
        else:
            ids = np.concatenate([self._encode(pa.array([part]))[0] for part in _parts(text)])
        return ids, np.array([0, len(ids)], dtype=np.int64)

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        whole = pc.match_substring_regex(texts, _WHOLE).to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(whole)
        marked = pc.binary_join_element_wise(pa.scalar(_FIRST), pc.if_else(pa.array(whole), "", texts), "")
        split = pc.split_pattern(pc.replace_substring(marked, "\n", " \n"), " ")
        bounds = np.asarray(split.offsets, dtype=np.int64) - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        code, pieces = np.asarray(coded.indices, dtype=np.int64), coded.dictionary
        # a piece is a stem and the punctuation that ends it, if the stem ends in a letter or digit
        stems = pc.utf8_rtrim(pieces, _PUNCTUATION)
        ended_ = pc.match_substring_regex(stems, r"[\p{L}\p{N}]$")
        stems = pc.if_else(ended_, stems, pieces)
        chars = pc.utf8_length(stems).to_numpy()
        cut = np.flatnonzero(chars < pc.utf8_length(pieces).to_numpy())
        endings = [p[n:] for p, n in zip(pieces.take(pa.array(cut)).to_pylist(), chars[cut].tolist())]
        ending = {e: k for k, e in enumerate(["", *dict.fromkeys(endings)])}
        end_of = np.zeros(len(pieces), dtype=np.int64)
        end_of[cut] = np.fromiter(map(ending.__getitem__, endings), np.int64, len(endings))
        stem = stems.dictionary_encode()
        stem_ids, stem_at = self._known(stem.dictionary)
        end_ids, end_at = self._known(pa.array([_FIRST + e for e in ending], pa.string()))
        heads = self.whole(texts.take(pa.array(rows)).to_pylist()) if len(rows) else []
        # what is laid out: each piece's stem and ending; a text kept whole has one empty piece
        order = np.empty(2 * len(code), dtype=np.int64)
        order[0::2] = stem_at[np.asarray(stem.indices)][code]
        order[1::2] = end_at[end_of[code]] + len(stem_ids)
        order[2 * bounds[rows]] = len(stem_ids) + len(end_ids) + np.arange(len(rows))
        laid = pa.concat_arrays([stem_ids, end_ids, pa.array([h.tobytes() for h in heads], pa.large_binary())]).take(pa.array(order))
        ends = np.frombuffer(laid.buffers()[1], np.int64, len(laid) + 1) // 4
        data = laid.buffers()[2]
        out = np.frombuffer(data, "<u4", int(ends[-1])) if data is not None else np.zeros(0, "<u4")
        return out, ends[2 * bounds]


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def ended(ids: np.ndarray, bounds: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text's ids."""
    n = len(bounds) - 1
    out = np.full(len(ids) + n, end_id, dtype="<u4")
    new = bounds + np.arange(n + 1)
    keep = np.ones(len(out), dtype=bool)
    keep[new[1:] - 1] = False
    out[keep] = ids
    return out, new
