"""Token ids of whole texts, fast: a batch's distinct words are encoded once.

Exact for a tokenizer whose pre-tokenizer drops white space and whose normaliser and merges never
look across it, and which ignores case (word_bpe_49k): then a text's ids are those of its space- and line-separated
pieces in turn. A piece of letters below U+0250 (all of them in normal form) and ASCII stops after them is two words, the letters,
lower-cased here, and the run of stops; so a word is remembered once, whatever stops follow it. Such letters skip the normaliser and
the pattern, which leave them as they are. Pieces of letters only are encoded many to a call and told apart by the tokens that end a
word; the rest one by one. Texts over _SLICE characters go in parts cut at a space.
"""

from __future__ import annotations

import codecs
import os
import string

import numpy as np

_SLICE = 1 << 22
#: Words an encoder remembers, about 150 bytes each.
CACHE = 1_000_000
#: Bytes of a word that is worth remembering; base64 and scripts without spaces make longer ones.
LONG = 64
_JOIN = 256
#: Letters below U+0250, all but U+0130, whose lower case is more than a letter.
_PLAIN = r"\A[A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]+\z"
#: What a tokenizer must treat as this module does; else it is refused.
_PROBE = "The QUICK brown fox's 3 tests,\nand cafés. Ünïcode \u6f22\u5b57 \U0001f600 a.b x,  y\r\n don't <|x|> 12.50 e\u0301 A\tB [INST]</s>"
_known: dict = {}


class Encoder:
    def __init__(self, path: str, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.plain = Tokenizer(self.tokenizer.model)  # shares the vocabulary's memory
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        #: The character that stands for each byte in the vocabulary, a space for itself.
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = {b: chr(0x100 + i) for i, b in enumerate(sorted(set(range(0x100)) - set(shown)))}
        self.letters = "".join(" " if b == 0x20 else hidden.get(b, chr(b)) for b in range(0x100))
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocab.values()) < 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        #: Ids of words, both as bytes.
        self.words: dict[bytes, bytes] = {b"": b""}
        self.cache = CACHE
        if self.encode([_PROBE])[0].tolist() != self.tokenizer.encode(_PROBE, add_special_tokens=False).ids:
            raise ValueError(f"{path} isn't a tokenizer that this module encodes exactly")

    @staticmethod
    def of(path: str, special_as_text: bool = False, cache: int = CACHE) -> Encoder:
        """This process's encoder for a file, to remember so many pieces."""
        key = (path, special_as_text)
        if key not in _known:
            _known[key] = Encoder(*key)
        _known[key].cache = cache
        return _known[key]

    def _ids(self, texts: list[str], tokenizer=None) -> list[np.ndarray]:
        found = (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype) for x in found]

    def _learn(self, plain: list[bytes], others: list[bytes]) -> None:
        """Puts the ids of words into self.words; plain: those that _PLAIN matches, lower-cased."""
        known, cores, odd = self.words, [], []
        for w in others:
            (cores if w.decode().isalpha() else odd).append(w)
        for words, tokenizer in ((plain, self.plain), (cores, self.tokenizer)):
            groups = [words[i : i + _JOIN] for i in range(0, len(words), _JOIN)]
            joined = [codecs.charmap_decode(t, "strict", self.letters)[0] if tokenizer is self.plain else t.decode() for t in map(b" ".join, groups)]
            for group, ids in zip(groups, self._ids(joined, tokenizer), strict=True):
                last = np.flatnonzero(self.ends[ids]) + 1
                if len(last) == len(group):
                    data, at = ids.tobytes(), 0
                    for w, e in zip(group, (last * self.dtype.itemsize).tolist(), strict=True):
                        known[w] = data[at:e]
                        at = e
                else:  # a letter whose lower case holds more than letters
                    odd += group
        for w, ids in zip(odd, self._ids([w.decode() for w in odd]), strict=True):
            known[w] = ids.tobytes()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in turn, and how many each text has."""
        import pyarrow as pa

        parts, owner = [], []
        for i, t in enumerate(texts):
            at = 0
            while len(t) - at > _SLICE and (to := max(t.rfind(" ", at, at + _SLICE), t.rfind("\n", at, at + _SLICE))) > at:
                parts.append(t[at:to])
                owner.append(i)
                at = to
            parts.append(t[at:] if at else t)
            owner.append(i)
        ids, counts, i = [], np.zeros(len(texts), np.int64), 0
        while i < len(parts):
            j, size = i, 0
            while j < len(parts) and (j == i or size < _SLICE):
                size += len(parts[j])
                j += 1
            flat, n = self._encode(parts[i:j])
            ids.append(flat)
            np.add.at(counts, owner[i:j], n)
            i = j
        pa.default_memory_pool().release_unused()
        return (np.concatenate(ids) if ids else np.zeros(0, self.dtype)), counts

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        import pyarrow as pa
        import pyarrow.compute as pc

        column = pa.array([t.encode("utf-8", "replace") for t in texts], pa.large_binary()).cast(pa.large_string())
        if not pc.any(pc.match_substring(column, "<|")).as_py():  # no special token's string, where case would count
            column = pc.ascii_lower(column)
        lists = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        per_text = np.asarray(lists.value_lengths(), np.int64)
        pieces = words.dictionary
        cores = pc.ascii_rtrim(pieces, string.punctuation)
        plain = pc.match_substring_regex(cores, _PLAIN)
        keys = pc.if_else(plain, pc.utf8_lower(cores), pieces).dictionary_encode()
        unique, row = _slices(keys.dictionary), np.array(keys.indices)
        plain, letters = np.asarray(plain), np.zeros(len(unique), bool)
        letters[row[plain]] = True
        length, core = np.asarray(pc.binary_length(pieces)), np.asarray(pc.binary_length(cores))
        stopped = np.flatnonzero(plain & (core < length))
        stops = _slices(pieces, core, stopped)
        runs = set(stops)
        if len(self.words) + len(unique) + len(runs) > self.cache + 1:  # what this batch needs stays, and with it all that is frequent
            self.words = {b"": b""} | {w: self.words[w] for w in (*unique, *runs) if w in self.words}
        known = self.words
        data = list(map(known.get, unique))
        missing = [i for i, ids in enumerate(data) if ids is None]
        runs = [w for w in runs if w not in known]
        new, others = [], []
        if missing or runs:
            missing = np.array(missing, np.int64)
            new = [unique[i] for i in missing[letters[missing]].tolist()]
            others = list({*runs, *(unique[i] for i in missing[~letters[missing]].tolist())})
            self._learn(new, others)
            for i in missing.tolist():
                data[i] = known[unique[i]]
        data += [data[k] + known[w] for k, w in zip(row[stopped].tolist(), stops, strict=True)]
        row[stopped] = np.arange(len(unique), len(data))
        for w in [w for w in (*new, *others) if len(w) > LONG]:
            del known[w]
        size = np.fromiter(map(len, data), np.int32, len(data)) // self.dtype.itemsize
        pool = np.frombuffer(b"".join(data), self.dtype)
        index = row[np.asarray(words.indices)]
        n = size[index]
        start = (np.cumsum(size, dtype=np.int32) - size)[index] - (np.cumsum(n, dtype=np.int32) - n)
        at = np.repeat(start, n)
        at += np.arange(len(at), dtype=np.int32)
        return pool[at], np.add.reduceat(n, np.cumsum(per_text) - per_text, dtype=np.int64)


def _slices(column, skip=0, rows=None) -> list[bytes]:
    """The values of a large_string column that starts at its buffers' beginning, or some rows of it, less so many bytes at the front."""
    if not len(column):
        return []
    _, offsets, raw = column.buffers()
    raw, to = raw.to_pybytes() if raw else b"", np.frombuffer(offsets, np.int64)[: len(column) + 1]
    begin, end = to[:-1] + skip, to[1:]
    if rows is not None:
        begin, end = begin[rows], end[rows]
    return [raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]


def with_end(flat: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with `end` after each text, and the new counts."""
    at = np.cumsum(counts + 1)
    out = np.empty(len(flat) + len(counts), flat.dtype)
    held = np.ones(len(out), bool)
    held[at - 1] = False
    out[held], out[~held] = flat, end
    return out, counts + 1


def groups(column, most: int = _SLICE):
    """Ranges (from, to) of an Arrow text column of about `most` bytes each, or one row."""
    import pyarrow.compute as pc

    size = np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
    at, held = 0, 0
    for i, n in enumerate(size.tolist()):
        if held and held + n > most:
            yield at, i
            at, held = i, 0
        held += n + 1
    if at < len(size):
        yield at, len(size)
