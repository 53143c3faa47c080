"""Token ids of whole texts by the tokenizers library, with recent words encoded once a worker.

For a vocabulary file with one of the two sets of rules below, the ids of a text are those of its split pieces in
order, and a piece is encoded by the file's own model. Any other file, and texts for which that might not
hold (characters outside Latin-1, special-token strings, separators that only Python treats as space), are
encoded whole.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from demandloom.llm.common import LONG_WORD, SLICE_BYTES, WORDS_KEPT, text_parts, worker_kept

#: Bytes of text that ``TextIds.ids_of`` is best given at a time: the more, the fewer repeats between slices.
TEXTS_BYTES = 4 * SLICE_BYTES

#: The rules of a vocabulary file whose words may be encoded one by one.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: The same splitter for the letters of Latin-1, and what the pieces may not be taken from.
_LETTERS = "a-zß-öø-ÿ"
_SPLIT = re.compile(rf"[{_LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\s{_LETTERS}0-9]+")
_ODD = re.compile("[^\t-\r !-~À-ÖØ-öø-ÿ]")
_LINE_SPLIT = re.compile(rf"\n|{_SPLIT.pattern}")
_EVEN = bytes(k for k in range(256) if not _ODD.match(chr(k)))


def _plain(text: str) -> bool:
    """True if no character is one of ``_ODD``; quicker for most texts than a search."""
    try:
        return not text.encode("latin-1").translate(None, _EVEN)
    except UnicodeEncodeError:
        return False


#: Fixed value: the rule of a vocabulary file over bytes, in which a word keeps the space before it.
BYTE_SPLITTER = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_ANY = "A-Za-zÀ-ÖØ-öø-ÿ"
_BYTE_SPLIT = re.compile(rf" ?[{_ANY}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\s{_ANY}0-9]+|\s+(?!\S)|\s+")
_ID = attrgetter("id")
_WORD_END = re.compile(r"\S(?=\s)")


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next code point from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b) if b in shown else chr(spare))
        spare += b not in shown
    return out


def splits_into_words(path: str) -> bool:
    """True if the file's rules are the ones that the splitter above restates."""
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    return rules.get("normalizer") == NORMALIZER and rules.get("pre_tokenizer") == SPLITTER and all(x["content"].startswith("<|") for x in rules.get("added_tokens", []))


def splits_into_spaced_words(path: str) -> bool:
    """True if the file's rules are those of ``BYTE_SPLITTER``."""
    with open(path, encoding="utf-8") as f:
        rules = json.load(f)
    return rules.get("normalizer") is None and rules.get("pre_tokenizer") == BYTE_SPLITTER and all(x["content"].startswith("<|") for x in rules.get("added_tokens", []))


def word_parts(text: str, size: int = SLICE_BYTES) -> Iterator[str]:
    """A text in parts of about ``size`` characters that end where a word ends, so that no run of white space is torn."""
    at = 0
    while len(text) - at > size:
        found = _WORD_END.search(text, at + size - 1)
        to = found.end() if found else len(text)
        yield text[at:to]
        at = to
    if at < len(text):
        yield text[at:]


def _lines(values: pa.Array) -> str:
    """All values, a line break between them."""
    return pc.binary_join(pa.ListArray.from_arrays([0, len(values)], values), "\n")[0].as_py() if len(values) else ""


def _runs(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """ids[start : start + size] for each start and size, one after another."""
    to = np.cumsum(sizes)
    return ids[np.repeat(starts - (to - sizes), sizes) + np.arange(int(to[-1]) if len(to) else 0)]


class Known:
    """Ids of recent strings in flat arrays, which are searched and added to for many strings at once.

    ``make`` gives the ids of strings, in order and one after another, and how many each has. Beyond ``most`` strings, or
    64 bytes for each of so many, only the short ones of the last call stay.
    """

    def __init__(self, make: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], most: int, kind: np.dtype):
        self.make, self.most = make, most
        self.keys, self.ids, self.sizes = pa.array([], pa.string()), np.zeros(0, kind), np.zeros(0, np.int64)

    def of(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``keys``, one after another, and how many each has."""
        found = pc.index_in(keys, value_set=self.keys)
        missing = found.is_null().to_numpy(zero_copy_only=False)
        at = found.fill_null(0).to_numpy().astype(np.int64)
        if missing.any():
            new = keys.filter(pa.array(missing))
            ids, sizes = self.make(new)
            at[missing] = len(self.keys) + np.arange(len(new))
            self.keys, self.ids, self.sizes = pa.concat_arrays([self.keys, new]), np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        out, sizes = _runs(self.ids, (np.cumsum(self.sizes) - self.sizes)[at], self.sizes[at]), self.sizes[at]
        if len(self.keys) > self.most or self.keys.nbytes + self.ids.nbytes > 64 * self.most:
            short = pc.less_equal(pc.binary_length(keys), LONG_WORD)
            kept = short.to_numpy(zero_copy_only=False)
            self.keys, self.ids, self.sizes = keys.filter(short), out[np.repeat(kept, sizes)], sizes[kept]
        return out, sizes


class TextIds:
    """Ids of texts as little-endian 16-bit (32-bit for large vocabularies) integers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.letters = _byte_letters()
        self.spaced = splits_into_spaced_words(path)
        self.older: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] | None = {} if self.spaced or splits_into_words(path) else None
        self.chunks, self.words = Known(self._chunk_ids, 2 * WORDS_KEPT, self.kind), Known(self._word_ids, 2 * WORDS_KEPT, self.kind)
        #: The model alone, over words in lines, and which ids end a word, if its vocabulary says so.
        self.lines, self.closing = Tokenizer(self.tokenizer.model), None
        self.lines.pre_tokenizer = CharDelimiterSplit("\n")
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if suffix and self.pieces is not None and not self.spaced:
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
            self.closing[[k for x, k in vocabulary.items() if x.endswith(suffix)]] = True

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _encoded(self, found: list[str]) -> bytes:
        """The ids of split pieces; what is new among them is encoded once, and remembered if it isn't long."""
        held, code, tokenize = self.pieces, "H" if self.kind.itemsize == 2 else "I", self.tokenizer.model.tokenize
        if len(held) > 2 * WORDS_KEPT:
            held.clear()
        fresh = set(found).difference(held)
        for piece in fresh:
            shown = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
            held[piece] = array(code, [t.id for t in tokenize(shown)]).tobytes()
        out = b"".join(map(held.__getitem__, found))
        for piece in [x for x in fresh if len(x) > LONG_WORD]:
            del held[piece]
        return out

    def _spaced(self, found: list[str]) -> bytes:
        """The ids of pieces that may begin with a space; of these there are more kinds, so two generations are remembered."""
        if len(self.pieces) > 2 * WORDS_KEPT:
            self.older = self.pieces
            self.pieces = {}
        held, older = self.pieces, self.older
        code, tokenize, letters = "H" if self.kind.itemsize == 2 else "I", self.tokenizer.model.tokenize, self.letters
        blank = letters[32]
        out = list(map(held.get, found))
        for k in [k for k, x in enumerate(out) if x is None]:
            piece = found[k]
            known = held.get(piece) or older.get(piece)  # an earlier one of this text may have been the same
            if known is None:
                shown = f"{blank}{piece[1:]}" if piece[0] == " " and piece[1:].isascii() and piece[1:].isalpha() else "".join([letters[b] for b in piece.encode()])
                known = array(code, list(map(_ID, tokenize(shown)))).tobytes()
            if len(piece) <= LONG_WORD:
                held[piece] = known
            out[k] = known
        return b"".join(out)

    def _word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of split pieces; the model takes all at once where it marks the end of a word, else one by one."""
        shown = _lines(words)
        if not shown.isascii():
            shown = "\n".join([x if x.isascii() else "".join([self.letters[b] for b in x.encode()]) for x in shown.split("\n")])
        if self.closing is not None:
            ids = np.array(self.lines.encode_batch_fast([shown], add_special_tokens=False)[0].ids, self.kind)
            to = np.nonzero(self.closing[ids])[0] + 1
            if len(to) == len(words) and (not len(to) or to[-1] == len(ids)):
                return ids, np.diff(to, prepend=0)
        found = [list(map(_ID, self.tokenizer.model.tokenize(x))) for x in shown.split("\n")[: len(words)]]
        return np.array([k for x in found for k in x], self.kind), np.array(list(map(len, found)), np.int64)

    def _chunk_ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of runs without white space, by their split pieces."""
        found = pa.array(_LINE_SPLIT.findall(f"{_lines(chunks)}\n".lower()), pa.string())
        between = pc.equal(found, "\n")
        coded = pc.dictionary_encode(found.filter(pc.invert(between)))
        ids, sizes = self.words.of(coded.dictionary)
        at, between = coded.indices.to_numpy(), between.to_numpy(zero_copy_only=False)
        each = np.zeros(len(found), np.int64)
        each[~between] = sizes[at]
        return _runs(ids, (np.cumsum(sizes) - sizes)[at], sizes[at]), np.diff(np.cumsum(each)[between], prepend=0)

    def _by_chunks(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """What ``ids_of`` returns; each kind of run without white space is looked up once.

        The splitter's pieces hold no white space and don't depend on what is beside the run.
        """
        split = pc.ascii_split_whitespace(texts)
        coded = pc.dictionary_encode(split.flatten())
        chunks, at = coded.dictionary, coded.indices.to_numpy()
        offsets = split.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        counts, marks, own = np.diff(offsets), np.full(len(texts), len(chunks)), []
        lines = _lines(chunks)
        if "<|" in lines or not _plain(lines):  # a text with such a run is one run of its own
            odd = np.array(["<|" in x or bool(_ODD.search(x)) for x in lines.split("\n")])
            met = np.concatenate([[0], np.cumsum(odd[at])])
            whole = met[offsets[1:]] > met[offsets[:-1]]
            at, counts = at[~np.repeat(whole, counts)], np.where(whole, 0, counts)
            own = [np.frombuffer(self._library(texts[int(k)].as_py()), self.kind) for k in np.nonzero(whole)[0]]
            marks[whole] += 1 + np.arange(len(own))
            chunks = pc.if_else(pa.array(odd), "", chunks)
        ids, sizes = self.chunks.of(chunks)
        blank = np.zeros(1, self.kind)  # where ``end`` goes
        ids = np.concatenate([ids, blank, *(x for ids_own in own for x in (ids_own, blank))])
        sizes = np.concatenate([sizes, [1], np.array([len(x) + 1 for x in own], np.int64)])
        ends = np.cumsum(counts)
        at = np.insert(at, ends, marks)
        out = _runs(ids, (np.cumsum(sizes) - sizes)[at], sizes[at]).astype("<u4")
        closed = np.cumsum(sizes[at])[ends + np.arange(len(texts))]
        out[closed - 1] = end
        return out, np.diff(closed, prepend=0)

    def ids_of(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts`` one after another, ``end`` behind each, as unsigned 32-bit integers, and how many each has.

        A null text counts as empty. Texts should be a slice of about ``TEXTS_BYTES``; one that is longer alone is taken in parts.
        """
        if self.pieces is None or self.spaced or not len(texts):
            found = [self.ids(text.as_py(), end) for text in texts]
            return np.concatenate([np.zeros(0, "<u4"), *found]), np.array(list(map(len, found)), np.int64)
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if len(texts) > 1 or pc.binary_length(texts)[0].as_py() <= TEXTS_BYTES:
            return self._by_chunks(texts, end)
        parts = [self._by_chunks(pa.array([part]), end)[0][:-1] for part in text_parts(texts[0].as_py())]
        out = np.concatenate([*parts, np.array([end], "<u4")])
        return out, np.array([len(out)], np.int64)

    def raw(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.pieces is None or "<|" in text:
            return self._library(text)
        if self.spaced:
            return b"".join([self._spaced(_BYTE_SPLIT.findall(part)) if _plain(part) else self._library(part) for part in word_parts(text)])
        return b"".join([self._library(part) if _ODD.search(part) else self._encoded(_SPLIT.findall(part.lower())) for part in text_parts(text)])

    def ids(self, text: str | None, end: int) -> np.ndarray:
        """All ids of ``text`` and then ``end``, as unsigned 32-bit integers."""
        raw = self.raw(text)
        out = np.empty(len(raw) // self.kind.itemsize + 1, "<u4")
        out[:-1] = np.frombuffer(raw, self.kind)
        out[-1] = end
        return out


def text_ids(path: str) -> TextIds:
    """The worker process's encoder for a vocabulary file."""
    return worker_kept(("ids", path), lambda: TextIds(path))


def default_tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
