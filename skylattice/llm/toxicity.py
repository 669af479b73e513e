"""Toxicity scores from a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

Each word enters as its own vector (known words) beside the mean vector of its hashed character trigrams (all words).
A window of WINDOW words goes through a gated recurrent layer in both directions, attention pools the states, and a
linear unit gives a logit; windows overlap by half, all of them are scored, and a document's logit is its highest.

Fitting uses at most `per_class` labelled rows of each class and `per_class * max_chars` characters: in hash
order of their ids rows of at most `max_chars` characters, and where these are too few longer ones, whole, or in evenly
spaced parts where they don't fit into what is left; of near copies one is learned from (`copies=False`); those bounds are parameters.
Scoring covers every text in full, by one path for all lengths: words go by in blocks that overlap by WINDOW - STRIDE words, so
the windows of a text are the same wherever blocks end. Null and empty texts get the score of one empty window. Ties and repeated
rows get equal scores. Without rows of both classes there is nothing to learn and every score is 0. A row's id, language, source
and labels never enter its score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, give_back, stage, text_batches, thrifty

WORD, BREAK = re.compile(r"[^\W_]+"), re.compile(r"[\W_]")
WINDOW, STRIDE, HIDDEN, WORD_DIM, CHAR_DIM, TRIGRAMS, ATTEND = 24, 12, 8, 8, 8, 4096, 8
BLOCK_WORDS, BLOCK_CHARS, MEMO = 30_000, 1 << 17, 200_000
PAD, UNKNOWN = 0, 1


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def blocks_of(text: str | None):
    """The words of a text in blocks of whole windows; each block begins with the last WINDOW - STRIDE words of the one before."""
    low, at, held, size = (text or "").lower(), 0, [], WINDOW + STRIDE * (BLOCK_WORDS // STRIDE)
    while at < len(low):
        end = BREAK.search(low, at + BLOCK_CHARS) if at + BLOCK_CHARS < len(low) else None
        end = end.start() if end else len(low)
        held += WORD.findall(low, at, end)
        at = end
        while len(held) > size:
            yield held[:size]
            held = held[size - WINDOW + STRIDE :]
    yield held


def trigrams(word: str) -> list[int]:
    b = b"^" + word.encode("utf-8", "surrogatepass") + b"$"
    return [(b[i] * 961 + b[i + 1] * 31 + b[i + 2]) * 2654435761 % (1 << 32) % TRIGRAMS for i in range(len(b) - 2)]


def sigmoid(x):
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


class Net:
    """Parameters and both passes. Words are rows of an input table; row 0 pads."""

    def __init__(self, vocab: dict[str, int], prior: np.ndarray, seed: int = 7):
        r, d, h = np.random.RandomState(seed), WORD_DIM + CHAR_DIM, HIDDEN
        self.vocab = vocab
        mat = lambda *s: (r.randn(*s) * (1 / np.sqrt(s[-2]))).astype(np.float32)
        self.p = {
            "words": (r.randn(len(vocab) + 2, WORD_DIM) * 0.1).astype(np.float32),
            "chars": (r.randn(TRIGRAMS, CHAR_DIM) * 0.1).astype(np.float32),
            "in": mat(d, 6 * h), "in_b": np.zeros(6 * h, np.float32), "rec": mat(2, h, 3 * h),
            "att": mat(2 * h, ATTEND), "att_b": np.zeros(ATTEND, np.float32), "att_v": mat(ATTEND, 1)[:, 0],
            "out": mat(2 * h, 1)[:, 0], "out_b": np.zeros(1, np.float32),
        }
        self.p["words"][2:, 0] = prior
        self.p["words"][:2] = 0
        self.shift = 0.0

    def rows(self, words: list[str]):
        """Input rows of words: (rows, ids, flat trigrams, counts)."""
        ids = np.array([self.vocab.get(w, UNKNOWN) for w in words])
        grams = [trigrams(w) for w in words]
        counts = np.array([len(g) for g in grams])
        flat = np.array([x for g in grams for x in g])
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        mean = np.add.reduceat(self.p["chars"][flat], starts, axis=0) / counts[:, None]
        return np.concatenate([self.p["words"][ids], mean], axis=1).astype(np.float32), ids, flat, counts

    def run(self, gates: np.ndarray, starts: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of the windows that begin at `starts`; gates: rows of both directions' input activations."""
        p, h, n = self.p, HIDDEN, len(starts)
        state, states, saved = np.zeros((2, n, h), np.float32), np.empty((2, WINDOW, n, h), np.float32), []
        g = np.empty((2, n, 3 * h), np.float32)
        fore, back = gates[:, : 3 * h], gates[:, 3 * h :]
        for t in range(WINDOW):
            g[0], g[1] = fore[starts + t], back[starts + WINDOW - 1 - t]
            a = state @ p["rec"]
            zr = sigmoid(g[..., : 2 * h] + a[..., : 2 * h])
            z, r, an = zr[..., :h], zr[..., h:], a[..., 2 * h :]
            new = np.tanh(g[..., 2 * h :] + r * an)
            if keep:
                saved.append((state, z, r, an, new))
            state = new + z * (state - new)
            states[0, t], states[1, WINDOW - 1 - t] = state
        both = np.concatenate([states[0], states[1]], axis=2)
        e = np.tanh(both @ p["att"] + p["att_b"])
        s = np.where(mask, e @ p["att_v"], np.float32(-30))
        w = np.exp(s - s.max(axis=0))
        w /= w.sum(axis=0)
        pooled = (w[..., None] * both).sum(axis=0)
        logit = pooled @ p["out"] + p["out_b"][0]
        return (logit, (saved, both, e, w, pooled, mask)) if keep else logit

    def gradients(self, d_logit: np.ndarray, cache, size: int, starts: np.ndarray):
        """Gradients of the parameters above the inputs, and of the gates."""
        p, h = self.p, HIDDEN
        saved, both, e, w, pooled, mask = cache
        g = {"out": pooled.T @ d_logit, "out_b": np.array([d_logit.sum()], np.float32)}
        d_pool = d_logit[:, None] * p["out"]
        d_both = w[..., None] * d_pool
        d_w = (both * d_pool).sum(axis=2)
        d_s = np.where(mask, w * (d_w - (w * d_w).sum(axis=0)), 0)
        g["att_v"] = np.einsum("tn,tna->a", d_s, e)
        d_e = d_s[..., None] * p["att_v"] * (1 - e * e)
        g["att"], g["att_b"] = np.einsum("tnk,tna->ka", both, d_e), d_e.sum(axis=(0, 1))
        d_both = d_both + d_e @ p["att"].T
        d_gates, g["rec"] = np.zeros((size, 6 * h), np.float32), np.zeros_like(p["rec"])
        d_state = np.zeros((2, len(d_logit), h), np.float32)
        for t in reversed(range(WINDOW)):
            state, z, r, an, new = saved[t]
            d_state = d_state + np.stack([d_both[t, :, :h], d_both[WINDOW - 1 - t, :, h:]])
            d_new = d_state * (1 - z) * (1 - new * new)
            d_z = d_state * (state - new) * z * (1 - z)
            d_r = d_new * an * r * (1 - r)
            d_a = np.concatenate([d_z, d_r, d_new * r], axis=2)
            g["rec"] += np.einsum("dnh,dng->dhg", state, d_a)
            d_state = d_state * z + d_a @ p["rec"].transpose(0, 2, 1)
            d_g = np.concatenate([d_z, d_r, d_new], axis=2)
            np.add.at(d_gates[:, : 3 * h], starts + t, d_g[0])
            np.add.at(d_gates[:, 3 * h :], starts + WINDOW - 1 - t, d_g[1])
        return g, d_gates


def window_count(n: int) -> int:
    return 1 + max(0, -(-(n - WINDOW) // STRIDE))


class Scorer:
    """Scores whole texts; input rows of words are kept in a table of bounded size."""

    def __init__(self, net: Net):
        self.net = net
        self.clear()

    def clear(self):
        self.known, self.size, self.table = {"": PAD}, 1, np.zeros((1024, WORD_DIM + CHAR_DIM), np.float32)

    def lookup(self, words: list[str]) -> np.ndarray:
        ids = list(map(self.known.get, words))
        if None in ids:
            new = list(dict.fromkeys(w for w, i in zip(words, ids) if i is None))
            if self.size + len(new) > MEMO:
                self.clear()
                new = list(dict.fromkeys(w for w in words if w))
            rows = self.net.rows(new)[0]
            while self.size + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[self.size : self.size + len(new)] = rows
            self.known.update(zip(new, range(self.size, self.size + len(new))))
            self.size += len(new)
            ids = list(map(self.known.get, words))
        return np.array(ids, dtype=np.int64)

    def windows(self, docs: list[list[str]]):
        """Padded words of documents, the first word of each window, and each window's document."""
        words, starts, owner = [], [], []
        for k, doc in enumerate(docs):
            n = window_count(len(doc))
            starts.append(len(words) + STRIDE * np.arange(n))
            owner.append(np.full(n, k))
            words += doc
            words += [""] * ((n - 1) * STRIDE + WINDOW - len(doc))
        return words, np.concatenate(starts), np.concatenate(owner)

    def logits(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each window: logit, owner and number within its document."""
        words, starts, owner = self.windows(docs)
        ids = self.lookup(words)
        gates = self.table[ids] @ self.net.p["in"] + self.net.p["in_b"]
        real, out = ids != PAD, []
        for k in range(0, len(starts), 2048):
            s = starts[k : k + 2048]
            out.append(self.net.run(gates, s, real[s[None, :] + np.arange(WINDOW)[:, None]]))
        first = np.searchsorted(owner, owner)
        return np.concatenate(out), owner, np.arange(len(owner)) - first

    def scores(self, texts) -> np.ndarray:
        """Probability per text; words are gathered to blocks, whether they come from one text or from many."""
        top, docs, of, held = np.full(len(texts), -np.inf), [], [], 0
        for k, text in enumerate(texts):
            for part in blocks_of(text):
                docs.append(part)
                of.append(k)
                held += len(part)
                if held > BLOCK_WORDS:
                    self.flush(docs, of, top)
                    docs, of, held = [], [], 0
        if docs:
            self.flush(docs, of, top)
        return sigmoid(top + self.net.shift)

    def flush(self, docs, of, top):
        logit, owner, _ = self.logits(docs)
        np.maximum.at(top, np.array(of)[owner], logit)


def distinct_rows(rows: list[tuple[list[str], int]]) -> list[tuple[list[str], int]]:
    """Without near copies of one label: a row goes if two of three minima over its word-triple hashes were seen under its label."""
    seen, out = [set(), set(), set()], []
    for words, label in rows:
        h = np.array([zlib.crc32(" ".join(words[i : i + 3]).encode("utf-8", "surrogatepass")) for i in range(max(1, len(words) - 2))], dtype=np.uint64)
        keys = [(label, int((h * np.uint64(m) % np.uint64(4294967291)).min())) for m in (1, 2654435761, 2246822519)]
        if sum(k in s for k, s in zip(keys, seen)) < 2:
            out.append((words, label))
        for k, s in zip(keys, seen):
            s.add(k)
    return out


def train(rows: list[tuple[str, int]], epochs: int = 5, batch: int = 128, min_steps: int = 60, vocab_size: int = 20_000, singles: int = 800, rate: float = 0.01, seed: int = 7, copies: bool = False) -> Net | None:
    """Fits on document labels: each epoch takes a toxic document's likeliest window and a clean one's likeliest and two others.

    `singles` words of clean documents are added as clean texts of one word. Without `copies` near copies of a row are left out.
    """
    data = [(words_of(t), int(y)) for t, y in rows]
    data = data if copies else distinct_rows(data)
    label = np.array([y for _, y in data])
    if not len(data) or label.min() == label.max():
        return None
    docs = [w for w, _ in data]
    count = [Counter(), Counter()]
    for w, y in data:
        count[y].update(set(w))
    total = Counter(count[0])
    total.update(count[1])
    kept = sorted((w for w in total if total[w] > 1), key=lambda w: (-total[w], w))[:vocab_size]
    n = np.bincount(label, minlength=2)
    odds = [np.log((count[1][w] + 2) / (n[1] + 4)) - np.log((count[0][w] + 2) / (n[0] + 4)) for w in kept]
    # what a few documents say of a word is chance
    odds = [o * (1 - np.exp(-total[w] / 5)) for o, w in zip(odds, kept)]
    rng = np.random.RandomState(seed)
    calm = sorted({w for w in count[0] if w not in count[1]} | {w for w, o in zip(kept, odds) if o < 1})
    single = [[w] for w in rng.choice(calm, min(singles, len(calm)), replace=False)] if calm else []
    docs, label = docs + single, np.concatenate([label, np.zeros(len(single), label.dtype)])
    net = Net({w: k + 2 for k, w in enumerate(kept)}, np.array(odds, np.float32) / 2, seed)
    m = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for epoch in range(epochs):
        if epoch:
            logit, owner, nth = in_blocks(Scorer(net), docs)
        else:
            prior = dict(zip(kept, odds))
            each = [[sum(max(0.0, prior.get(w, 0.0)) for w in d[STRIDE * k : STRIDE * k + WINDOW]) for k in range(window_count(len(d)))] for d in docs]
            logit = np.array([x for e in each for x in e])
            owner = np.repeat(np.arange(len(docs)), [len(e) for e in each])
            nth = np.concatenate([np.arange(len(e)) for e in each])
        order = np.lexsort((-logit, owner))
        first = order[np.searchsorted(owner[order], np.arange(len(docs)))]
        extra = rng.permutation(np.flatnonzero(label[owner] == 0))[: 2 * len(docs)]
        pick = np.unique(np.concatenate([first, extra]))
        # a small sample is gone over several times an epoch, so that the steps suffice
        turns = max(1, -(-min_steps * batch // max(1, len(pick))))
        queue = np.concatenate([rng.permutation(pick) for _ in range(turns)])
        for k in range(0, len(queue), batch):
            some = queue[k : k + batch]
            y = label[owner[some]].astype(np.float32)
            words = [docs[owner[i]][STRIDE * nth[i] : STRIDE * nth[i] + WINDOW] for i in some]
            uniq = {"": 0}
            ids = np.array([[uniq.setdefault(w, len(uniq)) for w in ws + [""] * (WINDOW - len(ws))] for ws in words])
            names = list(uniq)[1:]
            if not names:
                continue
            rows_, word_ids, flat, counts = net.rows(names)
            x = np.concatenate([np.zeros((1, rows_.shape[1]), np.float32), rows_])
            gates = (x @ net.p["in"] + net.p["in_b"])[ids.ravel()]
            starts = np.arange(len(some)) * WINDOW
            out, cache = net.run(gates, starts, (ids != 0).T, keep=True)
            weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())).astype(np.float32)
            g, d_gates = net.gradients((sigmoid(out) - y) * weight, cache, len(gates), starts)
            d_row = np.zeros((len(x), d_gates.shape[1]), np.float32)
            np.add.at(d_row, ids.ravel(), d_gates)
            g["in"], g["in_b"] = x.T @ d_row, d_row.sum(axis=0)
            d_x = (d_row @ net.p["in"].T)[1:]
            g["words"], g["chars"] = np.zeros_like(net.p["words"]), np.zeros_like(net.p["chars"])
            np.add.at(g["words"], word_ids, d_x[:, :WORD_DIM])
            np.add.at(g["chars"], flat, np.repeat(d_x[:, WORD_DIM:] / counts[:, None], counts, axis=0))
            step += 1
            for name, grad in g.items():
                grad = grad.astype(np.float32) + 1e-6 * net.p[name]
                a, b = m[name]
                a += 0.1 * (grad - a)
                b += 0.01 * (grad * grad - b)
                # vectors move slowly: with few documents they would learn their rare words by heart
                net.p[name] -= rate * {"words": 0.3, "chars": 0.5}.get(name, 1.0) * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-6)
    logit, owner, _ = in_blocks(Scorer(net), docs)
    top = np.full(len(docs), -np.inf)
    np.maximum.at(top, owner, logit)
    net.shift = -threshold(top, label)
    return net


def in_blocks(scorer: Scorer, docs):
    """Window logits of many documents without holding all their activations."""
    out, at = [], 0
    while at < len(docs):
        end, held = at, 0
        while end < len(docs) and (held == 0 or held + len(docs[end]) <= BLOCK_WORDS):
            held += len(docs[end]) + 1
            end += 1
        logit, owner, nth = scorer.logits(docs[at:end])
        out.append((logit, owner + at, nth))
        at = end
    return tuple(np.concatenate(x) for x in zip(*out))


def threshold(top: np.ndarray, label: np.ndarray) -> float:
    """The middle of the widest gap among the cuts of the fewest errors, each counted as a share of its class."""
    order = np.argsort(top)
    t, y = top[order], label[order]
    missed, alarms = np.concatenate([[0], np.cumsum(y)]) / max(1, y.sum()), np.concatenate([[(1 - y).sum()], (1 - y).sum() - np.cumsum(1 - y)]) / max(1, (1 - y).sum())
    cuts = np.concatenate([[t[0] - 2], (t[1:] + t[:-1]) / 2, [t[-1] + 2]])
    gap = np.concatenate([[0], t[1:] - t[:-1], [0]])
    loss = missed + alarms
    best = np.flatnonzero(loss <= loss.min() + 1e-9)
    return float(cuts[best[np.argmax(gap[best])]])


def spaced(text, n, share, part: int):
    """The text of n characters, or where that is over `share` as many parts of `part` characters as fit, spread evenly from its start to its end."""
    share = share if isinstance(share, Column) else F.lit(share)
    k = F.greatest(F.lit(1), F.floor(share / (part + 1))).cast("int")
    at = lambda i: (i * (n - part) / F.greatest(F.lit(1), k - 1)).cast("int") + 1
    return F.when(n <= share, text).otherwise(F.concat_ws(" ", F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.substring(text, at(i), F.lit(part)))))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500, max_chars: int = 4000, copies: bool = False, fold: int = 0, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Net | None:
    """Trains on labelled rows whose crc32(id as text) mod 5 isn't 0 (nor `fold`, which is for comparing variants): those of up to
    `max_chars` characters first, and longer ones where these don't fill `per_class`. The longer rows of a class share what is left of
    per_class * max_chars characters. Of rows that repeat an id one text is taken, and it is toxic if any label says so.

    Two scans of docs: the labelled rows' lengths, then the chosen rows' texts.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where("y in (0, 1)").where(~(F.crc32(F.col("id").cast("string")) % 5).isin(0, fold))
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("n", F.length("text")).where("n > 0")
    # ids first, so that only the chosen rows' texts move; the order by hash spreads the choice over the whole table
    sized = stage(texts.select("id", "n").join(known, "id").groupBy("id", "y").agg(F.min("n").alias("n")), "sized")
    chosen: dict = {}
    for y in (0, 1):
        short, left = True, per_class
        while left:
            got = sized.where((F.col("y") == y) & ((F.col("n") <= max_chars) == short)).orderBy(F.xxhash64("id"), "id").limit(left).collect()
            chosen |= {r["id"]: (y, short, r["n"]) for r in got}
            if not short:
                break
            short, left = False, left - len(got)
    if {y for y, _, _ in chosen.values()} != {0, 1}:
        return None
    share = {}
    for y in (0, 1):
        long = [n for of, short, n in chosen.values() if of == y and not short]
        share[y] = (per_class * max_chars - sum(n for of, short, n in chosen.values() if of == y and short)) // max(1, len(long))
    # at most 2 x per_class rows
    kind = docs.schema[id_col].dataType.simpleString()
    wanted = docs.sparkSession.createDataFrame([(i, n, share[y] if not short else n) for i, (y, short, n) in chosen.items()], f"id {kind}, n int, share int")
    found = texts.join(F.broadcast(wanted), ["id", "n"]).select("id", spaced(F.col("text"), F.col("n"), F.col("share"), max_chars).alias("text"))
    rows = [(r["text"], chosen[r["id"]][0], r["id"]) for r in found.groupBy("id").agg(F.min("text").alias("text")).collect()]
    rows.sort(key=lambda r: (zlib.crc32(str(r[2]).encode()), r[2]))
    return train([(t, y) for t, y, _ in rows], copies=copies)


def score(docs: DataFrame, net: Net | None, id_col: str = "doc_id", text_col: str = "text", keep: bool = False, out: str = "score") -> DataFrame:
    """(id, score) per row, or docs with a column `out` if keep. Only the text goes to Python, in a map over the scan."""
    if keep and out.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"docs already has a column {out}")

    text_batches(docs.sparkSession)

    @F.arrow_udf("double")
    def toxic(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(net)

        def work(texts):
            # few texts at a time are Python strings
            found = [scorer.scores(texts.slice(at, 256).to_pylist()) for at in range(0, len(texts), 256)]
            return [pa.array(np.concatenate(found or [np.empty(0)]).astype(np.float64))]

        try:
            yield from thrifty(batches, work)
        finally:
            scorer.clear()
            give_back()

    value = F.lit(0.0) if net is None else toxic(docs[text_col])
    return docs.select(*(docs[c] for c in (docs.columns if keep else [id_col])), value.alias(out))


def clean(docs: DataFrame, labels: DataFrame, at: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose score is below `at`, with the columns of docs, whatever these are called."""
    out = fresh(docs, "score")
    return score(docs, fit(docs, labels, id_col=id_col, text_col=text_col), id_col, text_col, keep=True, out=out).where(F.col(out) < at).select(*docs.columns)
