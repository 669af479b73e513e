"""Byte-pair encoding as a bounded-lookahead streaming transducer, and decoding as a byte-to-text state machine.

A text is fed in blocks. Three layers keep the state constant:

1. `cut`: a space before a character that isn't white space always starts a new pre-token, so the stream is cut there;
   the part after the last such cut waits for more input. A part beyond HOLD characters is cut at the last pre-token
   that three further characters can't change (the split pattern looks at most that far ahead).
2. `Transducer`: within a pre-token, the last token of each prefix follows from the tokens that end there and a
   pairwise compatibility test. A token leaves as soon as all prefixes that a future token can still attach to (the
   `lookahead` newest, the longest token's bytes, computed from the merge list) agree on it. A pre-token that ends
   within the lookahead, as nearly all do, is settled at its end by the same test (`Merges.window`).
3. a memo of bounded size from parts to their ids, so that frequent words are transduced once.

The file's added tokens (an end-of-text mark) are taken out of the whole text first, as the library does.
Null text counts as empty: no ids, the SHA-256 of nothing. Repeated rows give repeated results.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from struct import pack
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches

# Fixed value: the published split pattern of this vocabulary family.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPLIT = regex.compile(PATTERN)
CUT = re.compile(r" (?=\S)")
ODD = re.compile(r" (?=\s|\Z)")
AHEAD, HOLD, MEMO, FITS, BLOCK, ONE = 3, 1 << 16, 400_000, 500_000, 1 << 20, (1,)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable ones stand for themselves, the rest follow from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens of a byte-level tokenizer file, and the added ones that stand outside the merges."""

    def __init__(self, held: dict):
        model, letters = held["model"], byte_letters()
        self.raw = {t: bytes(letters[c] for c in t) for t in model["vocab"] if all(c in letters for c in t)}
        self.ids = {b: model["vocab"][t] for t, b in self.raw.items()}
        # added tokens are taken out of a text before it is split
        self.added = {t["content"]: t["id"] for t in held.get("added_tokens") or ()}
        if any(t.get(x) for t in held.get("added_tokens") or () for x in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that depend on what stands beside them aren't supported")
        self.special = re.compile("|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) or r"(?!)")


def read_file(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


class Merges(Vocabulary):
    """Vocabulary and merge list of a byte-level tokenizer file, and the lookahead they need."""

    def __init__(self, path: str):
        held = read_file(path)
        super().__init__(held)
        model, raw = held["model"], self.raw
        self.bytes = {i: b for b, i in self.ids.items()} | {i: t.encode("utf-8") for t, i in self.added.items()}
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for n, pair in enumerate(model["merges"]):
            a, b = (raw[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            self.rank.setdefault((self.ids[a], self.ids[b]), (n, self.ids[a + b]))
        # what each token was merged from and when; single bytes come from themselves, before all merges
        self.parts = {self.ids[bytes([b])]: (self.ids[bytes([b])],) * 2 for b in range(256)}
        self.born = dict.fromkeys(self.parts, -1)
        for (a, b), (n, made) in self.rank.items():
            if made not in self.born:
                self.born[made], self.parts[made] = n, (a, b)
        self.tokens = {self.bytes[i]: i for i in self.born if self.reduce(self.bytes[i]) == [i]}
        self.lookahead = max(map(len, self.tokens))
        ends: dict[bytes, set[int]] = {}
        for b in self.tokens:
            if len(b) > 1:
                ends.setdefault(b[-2:], set()).add(len(b))
        self.endings = {k: (*sorted(v, reverse=True), 1) for k, v in ends.items()}  # lengths of the tokens that end in two bytes
        starts: dict[bytes, set[int]] = {}
        for b in self.tokens:
            if len(b) > 1:
                starts.setdefault(b[:2], set()).add(len(b))
        self.starts = {k: (*sorted(v, reverse=True), 1) for k, v in starts.items()}
        self.fits: dict[tuple[int, int], bool] = {}

    def window(self, data: bytes) -> list[int]:
        """Ids of a whole pre-token that fits into the lookahead: longest tokens first, stepping back where two don't fit.

        A position from which no token fits is never tried again, so the steps stay in proportion to the bytes.
        """
        whole = self.tokens.get(data)
        if whole is not None:
            return [whole]
        tokens, starts, fits, size = self.tokens, self.starts, self.fits, len(data)
        out, ends, dead, pos, most = [], [0], set(), 0, size
        while pos < size:
            before = out[-1] if out else -1
            for n in starts.get(data[pos : pos + 2], ONE):
                if n > most or pos + n in dead or (t := tokens.get(data[pos : pos + n])) is None:
                    continue
                if before < 0:
                    break
                fit = fits.get((before, t))
                if fit is None:
                    if len(fits) > FITS:
                        fits.clear()
                    fit = fits[before, t] = self.compatible(before, t)
                if fit:
                    break
            else:
                if not out:
                    raise ValueError("the merge list doesn't cover a byte")
                dead.add(pos)
                out.pop()
                most = pos - ends[-2] - 1
                ends.pop()
                pos = ends[-1]
                continue
            out.append(t)
            pos += n
            ends.append(pos)
            most = size - pos
        return out

    def reduce(self, data: bytes) -> list[int]:
        """The merges applied in rank order, leftmost first: the definition."""
        seq = [self.ids[bytes([b])] for b in data]
        while len(seq) > 1:
            best = min(((self.rank[p][0], k) for k, p in enumerate(zip(seq, seq[1:])) if p in self.rank), default=None)
            if best is None:
                break
            k = best[1]
            seq[k : k + 2] = [self.rank[seq[k], seq[k + 1]][1]]
        return seq

    def compatible(self, a: int, b: int) -> bool:
        """Whether the bytes of a and b together encode to [a, b].

        Time runs backwards: the younger of the two tokens at the seam is undone, and a merge across the seam must
        not have come before the one that is undone (on the right side ties go to the seam, which is further left).
        """
        born, parts, rank, limit = self.born, self.parts, self.rank, 1 << 60
        while True:
            seam = rank.get((a, b))
            if seam is not None and seam[0] < limit:
                return False
            if born[a] < 0 and born[b] < 0:
                return True
            if born[a] > born[b]:
                limit, a = born[a], parts[a][1]
            else:
                limit, b = born[b] + 1, parts[b][0]


class Transducer:
    """Bytes of one pre-token in, ids out once stable; the state never exceeds a few lookaheads."""

    def __init__(self, merges: Merges):
        self.m, self.data, self.last, self.back, self.base = merges, b"", [], [], True

    def feed(self, data: bytes, end: bool) -> list[int]:
        m, buf = self.m, self.data + data
        last, back, tokens, endings, fits = self.last, self.back, m.tokens, m.endings, m.fits
        if not last:
            last.append(-1)
            back.append(-1)
        for p in range(len(last), len(buf) + 1):
            for n in endings.get(buf[p - 2 : p], ONE) if p > 1 else ONE:
                if n <= p and (t := tokens.get(buf[p - n : p])) is not None:
                    before = last[p - n]
                    if before < 0:
                        break
                    fit = fits.get((before, t))
                    if fit is None:
                        if len(fits) > FITS:
                            fits.clear()
                        fit = fits[before, t] = m.compatible(before, t)
                    if fit:
                        break
            else:
                raise ValueError("the merge list doesn't cover a byte")
            last.append(t)
            back.append(p - n)
        size = len(buf)
        if end:
            out, p = [], size
            while p > 0:
                out.append(last[p])
                p = back[p]
            self.data, self.last, self.back = b"", [], []
            return out[::-1]
        if size < 4 * m.lookahead:
            self.data = buf
            return []
        # the newest common ancestor of all prefixes that a later token can attach to
        chains = {size - k for k in range(m.lookahead)}
        while len(chains) > 1:
            chains.add(back[top := max(chains)])
            chains.remove(top)
        out, p = [], (stop := chains.pop())
        while p > 0:
            out.append(last[p])
            p = back[p]
        self.data, first = buf[stop:], last[stop]
        self.last = [first, *last[stop + 1 :]]
        self.back = [-1, *(b - stop for b in back[stop + 1 :])]
        return out[::-1]


def pieces(text: str, block: int = BLOCK) -> Iterator[list[str]]:
    """Parts of a text that encode independently, block by block; a part that starts with a space keeps it.

    Joined, the parts are the text. A part is longer than HOLD only inside one unbroken pre-token.
    """
    if len(text) <= block:
        yield cut(text)
        return
    held = ""
    for at in range(0, len(text), block):
        parts = cut(held + text[at : at + block])
        held = parts.pop()
        if len(held) > HOLD:
            stable = 0
            for m in SPLIT.finditer(held):
                if m.end() > len(held) - AHEAD:
                    break
                stable = m.end()
            parts.append(held[:stable])
            held = held[stable:]
        yield parts
    yield [held]


def cut(text: str) -> list[str]:
    parts = text.split(" ") if ODD.search(text) is None else CUT.split(text)
    return [parts[0], *(" " + p for p in parts[1:])]


class Encoder:
    """Texts to ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, merges: Vocabulary):
        self.merges, self.memo, self.words = merges, {}, {}

    def part(self, part: str) -> bytes:
        out = []
        for word in SPLIT.findall(part):
            ids = self.words.get(word)
            if ids is None:
                ids = self.word(word)
            out.append(ids)
        return b"".join(out)

    def word(self, word: str) -> bytes:
        data = word.encode("utf-8", "surrogatepass")
        if len(data) <= self.merges.lookahead:
            ids = self.merges.window(data)
        else:
            t, ids = Transducer(self.merges), []
            for at in range(0, len(data), HOLD):
                ids += t.feed(data[at : at + HOLD], at + HOLD >= len(data))
        ids = pack(f"<{len(ids)}I", *ids)
        if len(word) < 64:
            if len(self.words) >= MEMO:
                self.words.clear()
            self.words[word] = ids
        return ids

    def blocks(self, text: str) -> Iterator[bytes]:
        """Ids block by block. Added tokens are found in the whole text, so that no block's edge cuts one; what is between them encodes by itself."""
        at = 0
        for m in self.merges.special.finditer(text):
            yield from self.plain(text[at : m.start()])
            yield pack("<I", self.merges.added[m[0]])
            at = m.end()
        yield from self.plain(text[at:] if at else text)

    def plain(self, text: str) -> Iterator[bytes]:
        memo, get = self.memo, self.memo.get
        for parts in pieces(text):
            found = [get(p) for p in parts]
            if None in found:
                for k, ids in enumerate(found):
                    if ids is None:
                        ids = found[k] = memo.get(parts[k])
                        if ids is None:
                            ids = found[k] = self.part(parts[k])
                            if len(parts[k]) < 64:
                                if len(memo) >= MEMO:
                                    memo.clear()
                                memo[parts[k]] = ids
            yield b"".join(found)

    def encode(self, text: str | None) -> bytes:
        return b"".join(self.blocks(text or ""))


class Decoder:
    """Ids in, text out as soon as its bytes are complete; invalid bytes become U+FFFD."""

    def __init__(self, merges: Merges):
        self.table = merges.bytes
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: bytes, end: bool = False) -> str:
        table = self.table
        return self.machine.decode(b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]), end)


@lru_cache(2)
def merges(path: str) -> Merges:
    return Merges(path)


@lru_cache(4)
def encoder(path: str, native: bool = False) -> Encoder:
    """One per worker process, so that its memo outlives a task."""
    return NativeEncoder(path) if native else Encoder(merges(path))


class NativeEncoder(Encoder):
    """A compiled encoder over the same vocabulary, for operators that only need the ids. It takes whole blocks and keeps no memo."""

    def __init__(self, path: str):
        import tiktoken

        super().__init__(Vocabulary(read_file(path)))
        self.compiled = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=self.merges.ids, special_tokens={})

    def plain(self, text: str) -> Iterator[bytes]:
        for block in [text] if len(text) <= BLOCK else map("".join, pieces(text)):
            yield np.array(self.compiled.encode_ordinary(block), dtype="<u4").tobytes()


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) per row, streaming each whole text through encoder and decoder.

    A map over the scan: no shuffle; memory is one block, the memo and the running hashes.
    """
    import pandas as pd

    text_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids binary, decoded string" if keep_ids else "")

    def run(batches: Iterable[pd.DataFrame]):
        m, enc = merges(path), encoder(path)
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                dec, h_ids, h_text, n, keep, said = Decoder(m), hashlib.sha256(), hashlib.sha256(), 0, [], []
                for ids in enc.blocks(text or ""):
                    n += len(ids) // 4
                    h_ids.update(ids)
                    piece = dec.feed(ids)
                    h_text.update(piece.encode("utf-8", "surrogatepass"))
                    if keep_ids:
                        keep.append(ids)
                        said.append(piece)
                tail = dec.feed(b"", True)
                h_text.update(tail.encode("utf-8"))
                rows.append((n, h_ids.hexdigest(), h_text.hexdigest()) + ((b"".join(keep), "".join(said) + tail) if keep_ids else ()))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"] + (["ids", "decoded"] if keep_ids else []))
            out.insert(0, "id", pdf["id"].values)
            yield out

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, schema)
    return found.withColumnRenamed("id", id_col)
