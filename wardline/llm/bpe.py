"""BPE encoding as a bounded-lookahead streaming transducer, decoding as an incremental state machine.

The merge list decides, for every prefix of a word, which token its encoding
ends in: the one token ``t`` for which the pair (last token of what stands
before ``t``, ``t``) is itself an encoding, i.e. the merges applied to the
joined pair give the pair back.  So a word can be read left to right, one
symbol at a time, keeping one such token per prefix.  A later symbol can only
attach to prefixes within the longest token's reach; that reach is the merge
list's sufficient lookahead (``lookahead``).  Tokens that all prefixes within
it agree on are stable: they are emitted and forgotten, so the state of a word
is bounded by the lookahead, however long the word is.

Rows: ``encode`` returns one row per input row.  Null text counts as empty: no
tokens, the digests of nothing.  Repeated rows are encoded each.  Other columns
of the input are not read; a doc_id that is null stays null.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Words and pieces of words kept with their tokens in one Python worker; a full memory starts anew.
WORD_MEMORY = 200_000
PIECE_MEMORY = 400_000
PAIR_MEMORY = 2_000_000
#: Longer words are streamed and not remembered.
LONGEST_REMEMBERED = 256


def byte_alphabet() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for 256, 257, ..."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in
                                         enumerate(b for b in range(256) if b not in set(plain))}


class Merges:
    """Vocabulary and merge list of a word-level BPE with an end-of-word suffix."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.rank = {tuple(p.split(" ") if isinstance(p, str) else p): i for i, p in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in (self.vocab | self.special).items()}
        self.lookahead = max(map(self.symbols, self.vocab))
        self.valid: dict[tuple[str | None, str], bool] = {}

    def symbols(self, token: str) -> int:
        return len(token) - (len(self.end) if self.end and token.endswith(self.end) else 0)

    def merged(self, text: str) -> list[str]:
        """The merges applied to a short symbol string, lowest rank first, leftmost first."""
        last = bool(self.end) and text.endswith(self.end)
        parts = list(text[:-len(self.end)] if last else text)
        if last:
            parts[-1] += self.end
        rank = self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get((parts[i], parts[i + 1]))
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            pair, out, i = (parts[at], parts[at + 1]), [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(pair[0] + pair[1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def fits(self, before: str | None, token: str) -> bool:
        """Whether an encoding that ends in ``before`` can go on with ``token``."""
        key = (before, token)
        known = self.valid.get(key)
        if known is None:
            if len(self.valid) >= PAIR_MEMORY:
                self.valid.clear()
            known = self.merged((before or "") + token) == ([token] if before is None else [before, token])
            self.valid[key] = known
        return known


class Transducer:
    """Reads the symbols of one word, emits token ids as soon as they are stable."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.text = ""               # symbols since the last stable boundary
        self.ends: list[str | None] = [None]   # last token of each prefix of ``text``
        self.before: str | None = None         # the stable token before it

    def _step(self, symbols: str, suffix: str = "") -> None:
        """Read symbols; ``suffix`` marks the last of them as the word's end."""
        m, ends = self.m, self.ends
        vocab, valid, fits, reach, before = m.vocab, m.valid, m.fits, m.lookahead, self.before
        n = len(self.text)
        self.text = text = self.text + symbols
        marked = text + suffix
        total = len(text)
        for n in range(n + 1, total + 1):
            source, stop = (marked, len(marked)) if n == total else (text, n)
            found = None
            for start in range(n - reach if n > reach else 0, n):
                token = source[start:stop]
                if token in vocab:
                    prior = ends[start] if start else before
                    if start and prior is None:
                        continue
                    key = (prior, token)
                    if valid[key] if key in valid else fits(prior, token):
                        found = token
                        break
            ends.append(found)

    def _stable(self) -> int:
        """The last boundary that every live prefix (within the lookahead) passes through."""
        n = len(self.text)
        live = [i for i in range(max(1, n - self.m.lookahead + 1), n + 1) if self.ends[i] is not None]
        at = set(live)
        while len(at) > 1:
            last = max(at)
            at.discard(last)
            at.add(last - self.m.symbols(self.ends[last]))
        return at.pop() if at else 0

    def _emit(self, upto: int) -> list[int]:
        out, i = [], upto
        while i > 0:
            token = self.ends[i]
            out.append(token)
            i -= self.m.symbols(token)
        out.reverse()
        if out:
            self.before = out[-1]
            self.text, self.ends = self.text[upto:], [None, *self.ends[upto + 1:]]
        return [self.m.vocab[t] for t in out]

    def word(self, symbols: str) -> Iterator[list[int]]:
        """Token ids of one word in stable pieces."""
        whole = symbols + self.m.end
        if whole in self.m.vocab and self.m.fits(None, whole):
            yield [self.m.vocab[whole]]
            return
        step = 2 * self.m.lookahead
        last = len(symbols) - 1
        for i in range(0, last, step):
            self._step(symbols[i:min(i + step, last)])
            if len(self.text) > step:
                yield self._emit(self._stable())
        self._step(symbols[last:], self.m.end)
        yield self._emit(len(self.text))


class Codec:
    """Text to token ids and back, for the word-level layout: lower case, white space dropped."""

    ODD = re.compile("[\x1c-\x1f]")  # white space to str.split, not to Unicode
    SPACE = regex.compile(r"\p{White_Space}+")
    # fixed values: the tokenizer's split pattern after white space is gone
    PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+")

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.m = Merges(json.load(f))
        letters = byte_alphabet()
        self.letter = [letters[b] for b in range(256)]
        self.byte = {c: b for b, c in letters.items()}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.m.special, key=len, reverse=True)))
                                        + ")") if self.m.special else None
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.prefixes: dict[str, str | None] = {}

    def _short(self, symbols: str) -> bytes:
        """A word within the lookahead: what its prefixes end in is remembered across words."""
        m, known = self.m, self.prefixes
        vocab, valid, fits = m.vocab, m.valid, m.fits
        whole = symbols + m.end
        ends, last = [None], len(symbols)
        for n in range(1, last + 1):
            prefix = symbols[:n] if n < last else whole
            found = known.get(prefix, "")
            if found == "":
                found = None
                for start in range(n):
                    token = prefix[start:]
                    if token in vocab:
                        prior = ends[start]
                        if start and prior is None:
                            continue
                        key = (prior, token)
                        if valid[key] if key in valid else fits(prior, token):
                            found = token
                            break
                if n < last:
                    if len(known) >= PIECE_MEMORY:
                        known.clear()
                    known[prefix] = found
            ends.append(found)
        ids, n = [], last
        while n > 0:
            token = ends[n]
            ids.append(vocab[token])
            n -= len(token) - (len(m.end) if n == last else 0)
        ids.reverse()
        return array("I", ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        symbols = piece if piece.isalpha() and piece.isascii() else \
            "".join([self.letter[b] for b in piece.encode("utf-8")])
        if len(symbols) <= self.m.lookahead:
            out = self._short(symbols)
        else:
            out = b"".join([array("I", ids).tobytes() for ids in Transducer(self.m).word(symbols)])
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self.pieces) >= PIECE_MEMORY:
                self.pieces.clear()
            self.pieces[piece] = out
        return out

    def _word(self, raw: str) -> bytes:
        word = raw.lower() if raw.isascii() else unicodedata.normalize("NFC", raw).replace("Σ", "σ").lower()
        known, make = self.pieces, self._piece
        out = b"".join([known[p] if p in known else make(p) for p in self.PIECES.findall(word)])
        if len(raw) <= LONGEST_REMEMBERED:
            if len(self.words) >= WORD_MEMORY:
                self.words.clear()
            self.words[raw] = out
        return out

    def _plain(self, text: str) -> bytes:
        words = text.split() if not self.ODD.search(text) else self.SPACE.split(text)
        known, make = self.words, self._word
        return b"".join([known[w] if w in known else make(w) for w in words])

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a whole text; the strings of special tokens are those tokens."""
        if self.split_special is None or "<|" not in text:
            return self._plain(text)
        return b"".join(array("I", [self.m.special[part]]).tobytes() if part in self.m.special else self._plain(part)
                        for part in self.split_special.split(text) if part)

    def joined(self, ids: Iterable[int]) -> str:
        """The library's decode without a decoder: token strings with a space between."""
        return " ".join(map(self.m.strings.__getitem__, ids))


class TextDecoder:
    """Token ids to text, one at a time: byte-level letters to bytes, bytes to text as characters complete."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def push(self, token_id: int) -> str:
        m = self.codec.m
        token = m.strings[token_id]
        if token in m.special:
            return self.utf8.decode(b"", True) + token
        ended = bool(m.end) and token.endswith(m.end)
        letters = token[:-len(m.end)] if ended else token
        text = self.utf8.decode(bytes(self.codec.byte[c] for c in letters), ended)
        return text + " " if ended else text

    def finish(self) -> str:
        return self.utf8.decode(b"", True)


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a vocabulary file, loaded once in a Python worker."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, vocab_path: str, keep_ids: bool = False) -> DataFrame:
    """Encode ``text`` and decode it again: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids).

    ``vocab_path`` names a tokenizer file present on every machine.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if keep_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocab_path)
        for batch in batches:
            counts, sums, decoded, all_ids = [], [], [], []
            for text in batch.column("text"):
                data = c.encode(text.as_py() or "")
                ids = memoryview(data).cast("I") if data else ()
                counts.append(len(ids))
                sums.append(hashlib.sha256(data).hexdigest())
                decoded.append(hashlib.sha256(c.joined(ids).encode("utf-8")).hexdigest())
                if keep_ids:
                    all_ids.append(list(ids))
            cols = [batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()),
                    pa.array(sums, pa.string()), pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
