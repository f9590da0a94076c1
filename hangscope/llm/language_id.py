"""Language ID with a linear-chain conditional random field over words.

Each word of a text gets a language; neighbours are tied by learned
transitions, so runs of words in another language inside a text are labelled
as such.  Features of a word: itself (lexicon), its letter bigrams and
trigrams with marks at both ends (so its first and last one or two letters
too), and its first and last three letters, hashed into ``DIMS`` weights per
language.  Forward-backward gives the posterior of each word's
language; a text's language has the largest sum of posteriors and its score is
their mean.

Training: a bounded sample of labelled rows (``PER_LANG`` per language, one
window of about ``WINDOW_CHARS`` characters of each), of which pairs from any
two languages are joined into code-switched sequences; stochastic gradients of
the conditional likelihood on the driver.  The model is ``DIMS`` x languages
floats, whatever the corpus.

Prediction: one pass over the whole texts, no shuffle.  A text's words are cut
into segments of ``SEGMENT`` that are worked on side by side; messages across
segment borders are exact (products of transfer matrices), so the result is that of one
chain over the whole text.  Emissions of up to ``CACHE_WORDS`` words are kept
per worker.

Edge cases: a null text or one without a letter is ``und`` with score 0; with
nothing to learn from, every text is; a null label or id is not learned from;
a null id is not held out; ties go to the first label in order; repeated rows
get equal results; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow

DIMS = 1 << 16
PER_LANG = 400
WINDOW_CHARS = 700
MAX_LANGS = 1000
EPOCHS = 4
SEGMENT = 256
ROWS = 2048          # segments worked on side by side
CACHE_WORDS = 250_000
UND = "und"
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    if not text:
        return []
    found = _WORD.findall(text.lower())
    return found if all(map(str.isalpha, found)) else [w for w in found if any(map(str.isalpha, w))]


def _slots(kind: int, *codes: np.ndarray) -> np.ndarray:
    """Hash of a letter sequence (one array per place) to a weight."""
    h = np.full(codes[0].shape, kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
    for c in codes:
        h = (h ^ c) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(DIMS)).astype(np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Weight slots of all words' features, word after word, and the number of each word's."""
    size = np.array([len(w) + 2 for w in words])
    c = np.frombuffer("".join([f"^{w}$" for w in words]).encode("utf-32-le"), np.uint32).astype(np.uint64)
    end = np.cumsum(size)
    begin, word = end - size, np.repeat(np.arange(len(words)), size)
    left = end[word] - np.arange(len(c))          # letters from here to the end of the word
    two, three, long = np.flatnonzero(left > 1), np.flatnonzero(left > 2), np.flatnonzero(size > 3)
    place = (np.arange(len(c)) - begin[word]).astype(np.uint64)
    whole = np.add.reduceat((c + place * np.uint64(0x632BE5AB)) * (c ^ np.uint64(0x9E3779B97F4A7C15)) * (place * np.uint64(2) + np.uint64(1)), begin)
    b, e = begin[long], end[long]
    found = [_slots(1, whole), _slots(2, c[two], c[two + 1]), _slots(3, c[three], c[three + 1], c[three + 2]),
             _slots(4, c[b], c[b + 1], c[b + 2], c[b + 3]), _slots(5, c[e - 4], c[e - 3], c[e - 2], c[e - 1])]
    owner = np.concatenate([np.arange(len(words)), word[two], word[three], long, long])
    return np.concatenate(found)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray      # DIMS x languages
    start: np.ndarray        # languages
    trans: np.ndarray        # from x to

    def emissions(self, words: list[str]) -> np.ndarray:
        """exp(score - largest score) of each word and language."""
        if not words:
            return np.empty((0, len(self.langs)))
        flat, n = features(words)
        e = np.add.reduceat(self.weights[flat], np.cumsum(n) - n, axis=0)
        return np.exp(e - e.max(1, keepdims=True))


def _norm(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(-1, keepdims=True), 1e-300)


def posteriors(psi: np.ndarray, lens: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each word of chains laid end to end (``lens`` words each); also their sums by chain."""
    n_lang, trans, start = len(model.langs), np.exp(model.trans), np.exp(model.start)
    out, sums = np.empty((len(psi), n_lang)), np.zeros((len(lens), n_lang))
    per = (lens + SEGMENT - 1) // SEGMENT
    chain = np.repeat(np.arange(len(lens)), per)
    number = np.arange(len(chain)) - np.repeat(np.cumsum(per) - per, per)
    at = np.repeat(np.cumsum(lens) - lens, per) + number * SEGMENT
    size = np.minimum(np.repeat(lens, per) - number * SEGMENT, SEGMENT)
    first, final = number == 0, number == np.repeat(per, per) - 1
    # messages into each segment from the left and from the right
    left, right = np.ones((len(chain), n_lang)), np.ones((len(chain), n_lang))
    several = np.flatnonzero(~(first & final))
    if len(several):
        moves = np.empty((len(several), n_lang, n_lang))
        for rows in _blocks(several, size):
            moves[np.searchsorted(several, rows)] = _transfer(psi, at[rows], size[rows], first[rows], trans, start)
        where = np.full(len(chain), -1)
        where[several] = np.arange(len(several))
        for k in range(1, int(per.max())):     # the k-th segments of all chains at once
            now = np.flatnonzero(number == k)
            before = now - 1
            left[now] = _norm(np.einsum("si,sij->sj", left[before], moves[where[before]]))
        for k in range(int(per.max()) - 2, -1, -1):
            now = np.flatnonzero((number == k) & ~final)
            right[now] = _norm(np.einsum("sij,sj->si", moves[where[now + 1]], right[now + 1]))
    for rows in _blocks(np.arange(len(chain)), size):
        _smooth(psi, at[rows], size[rows], first[rows], left[rows], right[rows], trans, start, out)
    if len(psi):
        full = lens > 0
        sums[full] = np.add.reduceat(out, (np.cumsum(lens) - lens)[full], axis=0)
    return out, sums


def _blocks(rows: np.ndarray, size: np.ndarray):
    """Rows in order of falling size, ROWS at a time."""
    rows = rows[np.argsort(-size[rows], kind="stable")]
    for i in range(0, len(rows), ROWS):
        yield rows[i:i + ROWS]


def _transfer(psi, at, size, first, trans, start) -> np.ndarray:
    """For each segment the matrix that takes the message before it to the one behind it."""
    m = np.where(first[:, None, None], start[None, None, :], trans[None]) * psi[at][:, None, :]
    m /= m.max((1, 2), keepdims=True)
    for t in range(1, int(size[0])):
        k = int(np.searchsorted(-size, -t, side="left"))
        m[:k] = (m[:k] @ trans) * psi[at[:k] + t][:, None, :]
        m[:k] /= np.maximum(m[:k].max((1, 2), keepdims=True), 1e-300)
    return m


def _smooth(psi, at, size, first, left, right, trans, start, out) -> None:
    longest = int(size[0])
    alpha = np.empty((longest, len(at), psi.shape[1]))
    alpha[0] = _norm(np.where(first[:, None], start, left @ trans) * psi[at])
    ks = [len(at)] + [int(np.searchsorted(-size, -t, side="left")) for t in range(1, longest)]
    for t in range(1, longest):
        k = ks[t]
        alpha[t, :k] = _norm((alpha[t - 1, :k] @ trans) * psi[at[:k] + t])
    beta = right.copy()
    for t in range(longest - 1, -1, -1):
        k = ks[t]
        out[at[:k] + t] = _norm(alpha[t, :k] * beta[:k])
        if t:
            beta[:k] = _norm((beta[:k] * psi[at[:k] + t]) @ trans.T)


# --- training -------------------------------------------------------------------

def training_windows(docs: DataFrame, doc_id: str, text: str, lang: str, per_lang: int = PER_LANG) -> list[tuple[str, str]]:
    """(language, window of a text) of a bounded, stratified sample of the rows to learn from."""
    i, t, lab = (F.col(f"`{c}`") for c in (doc_id, text, lang))
    rows = docs.select(i.alias("i"), t.alias("t"), lab.alias("lang")).filter(
        t.isNotNull() & lab.isNotNull() & (F.crc32(i.cast("string")) % 3 != 1))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGS + 1).collect()}
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not counts:
        return []
    weight = F.create_map(*[F.lit(x) for kv in sorted(counts.items()) for x in kv])
    h = F.xxhash64(F.lit("language sample"), "i", "t")
    spot = F.pmod(F.xxhash64(F.lit("window"), "i", "t"), F.greatest(F.length("t") - WINDOW_CHARS, F.lit(1))).cast("int") + 1
    u = F.pmod(h, F.lit(1 << 40))
    order = (u + 1) * weight[F.col("lang")]
    # about twice the rows wanted of each language go on to be ordered
    taken = rows.filter(u * weight[F.col("lang")] < F.lit(float(2 * per_lang + 100) * (1 << 40))).select("lang", F.substring("t", spot, F.lit(WINDOW_CHARS + 1)).alias("w"), order.alias("o"), "i").orderBy("o", "i", "w").limit(
        per_lang * len(counts))
    return [(r["lang"], r["w"]) for r in taken.collect()]


def _marginals(psi: np.ndarray, lens: np.ndarray, start: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each word of short chains, and the expected number of each transition."""
    order = np.argsort(-lens, kind="stable")
    size, at = lens[order], (np.cumsum(lens) - lens)[order]
    move, ks = np.exp(trans), [int((size > t).sum()) for t in range(int(size[0]))]
    alpha, out, expected = np.empty((len(ks), len(at), psi.shape[1])), np.empty_like(psi), np.zeros_like(trans)
    alpha[0] = _norm(np.exp(start) * psi[at])
    for t in range(1, len(ks)):
        k = ks[t]
        alpha[t, :k] = _norm((alpha[t - 1, :k] @ move) * psi[at[:k] + t])
    beta = np.ones((len(at), psi.shape[1]))
    for t in range(len(ks) - 1, -1, -1):
        k = ks[t]
        out[at[:k] + t] = _norm(alpha[t, :k] * beta[:k])
        if t:
            ahead = beta[:k] * psi[at[:k] + t]
            both = alpha[t - 1, :k, :, None] * move * ahead[:, None, :]
            expected += (both / both.sum((1, 2), keepdims=True)).sum(0)
            beta[:k] = _norm(ahead @ move.T)
    return out, expected


def fit(windows: list[tuple[str, str]], epochs: int = EPOCHS, seed: int = 7) -> Model | None:
    """Train on windows of one language each, joined in pairs."""
    rng = np.random.default_rng(seed)
    langs = sorted({x for x, _ in windows})
    data = [(langs.index(x), words_of(w)[1:-1]) for x, w in windows]
    data = [(y, ws) for y, ws in data if ws]
    if not data:
        return None
    n_lang = len(langs)
    vocabulary = {w: k for k, w in enumerate(dict.fromkeys(w for _, ws in data for w in ws))}
    flat, n_feats = features(list(vocabulary))
    cuts = np.cumsum(n_feats) - n_feats
    ids = [np.array([vocabulary[w] for w in ws]) for _, ws in data]
    weights, start, trans = np.zeros((DIMS, n_lang), np.float64), np.zeros(n_lang), np.zeros((n_lang, n_lang))
    sq_w, sq_t = np.full((DIMS, n_lang), 1e-8), np.full((n_lang, n_lang), 1e-8)
    model, rate = Model(langs, weights, start, trans), 0.3
    for _ in range(epochs):
        order = rng.permutation(len(data))
        pairs = [order[k:k + 2] for k in range(0, len(order), 2)]
        for at in range(0, len(pairs), 32):
            batch = pairs[at:at + 32]
            toks = np.concatenate([ids[d] for p in batch for d in p])
            gold = np.concatenate([np.full(len(ids[d]), data[d][0]) for p in batch for d in p])
            lens = np.array([sum(len(ids[d]) for d in p) for p in batch])
            used, back = np.unique(toks, return_inverse=True)
            spans = np.concatenate([np.arange(cuts[u], cuts[u] + n_feats[u]) for u in used])
            fs, sizes = flat[spans], n_feats[used]
            e = np.add.reduceat(weights[fs], np.cumsum(sizes) - sizes, axis=0)
            psi = np.exp(e - e.max(1, keepdims=True))[back]
            post, pairs_seen = _marginals(psi, lens, start, trans)
            g = -post
            g[np.arange(len(toks)), gold] += 1
            per_word = np.zeros((len(used), n_lang))
            np.add.at(per_word, back, g)
            grad = np.zeros((DIMS, n_lang))
            np.add.at(grad, fs, np.repeat(per_word, sizes, axis=0))
            grad = grad / len(toks) * 10 - 1e-6 * weights
            sq_w += grad ** 2
            weights += rate * grad / np.sqrt(sq_w)
            heads = np.cumsum(lens) - lens
            start += rate * g[heads].mean(0)
            # transitions: seen minus expected
            i = np.setdiff1d(np.arange(len(toks) - 1), heads - 1)
            gt = -pairs_seen
            np.add.at(gt, (gold[i], gold[i + 1]), 1)
            gt = gt / len(toks) * 10 - 1e-4 * trans
            sq_t += gt ** 2
            trans += rate * gt / np.sqrt(sq_t)
    model.weights = weights.astype(np.float32)
    return model


# --- prediction -----------------------------------------------------------------

SPANS = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))


class Labeller:
    def __init__(self, model: Model):
        self.model, self.known, self.table, self.used = model, {}, np.empty((CACHE_WORDS + 1, len(model.langs)), np.float32), 0

    def psi(self, texts: list[list[str]]) -> np.ndarray:
        """Emissions of all words, in order."""
        parts = []
        for ws in texts:
            known = self.known
            got = [known.get(w, -1) for w in ws]
            if -1 in got:
                new = list({w for w, k in zip(ws, got) if k < 0})
                if len(new) > CACHE_WORDS // 2:      # a text with more distinct words than are worth keeping
                    parts += [self.model.emissions(ws[k:k + 10_000]) for k in range(0, len(ws), 10_000)]
                    continue
                if self.used + len(new) > CACHE_WORDS:
                    self.known, self.used = {}, 0
                    known, new = self.known, list(set(ws))
                    if len(new) > CACHE_WORDS:
                        parts += [self.model.emissions(ws[k:k + 10_000]) for k in range(0, len(ws), 10_000)]
                        continue
                self.table[self.used:self.used + len(new)] = self.model.emissions(new)
                known.update(zip(new, range(self.used, self.used + len(new))))
                self.used += len(new)
                got = [known[w] for w in ws]
            parts.append(self.table[got])
        return np.concatenate(parts).astype(np.float64) if parts else np.empty((0, len(self.model.langs)))

    def label(self, texts: list, spans: bool = False) -> list[tuple[str, float, list | None]]:
        ws = [words_of(t) for t in texts]
        lens = np.array([len(w) for w in ws])
        post, sums = posteriors(self.psi([w for w in ws if w]), lens, self.model)
        out, at = [], 0
        for n, s in zip(lens.tolist(), sums):
            runs = None
            if spans:
                best = post[at:at + n].argmax(1)
                cut = np.flatnonzero(np.diff(best)) + 1
                runs = [{"lang": self.model.langs[best[a]], "first": int(a), "last": int(b) - 1}
                        for a, b in zip([0, *cut], [*cut, n])] if n else []
            out.append((self.model.langs[int(s.argmax())], min(1.0, float(s.max() / n)), runs) if n else (UND, 0.0, runs))
            at += n
        return out


def identify(docs: DataFrame, model: Model | None, text: str = "text", spans: bool = False, keep_text: bool = False,
             batch_chars: int = 4_000_000) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and, if asked, ``spans`` (runs of words of one language); without ``text`` unless it is to be kept."""
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())] + ([T.StructField("spans", SPANS)] if spans else [])
    names = {f.name for f in added}
    others = [f for f in docs.schema.fields if f.name != text and f.name not in names]
    held = [docs.schema[text]] if keep_text else []
    kinds = [pa.string(), pa.float64(), pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))]

    def run(batches):
        labeller = Labeller(model) if model else None
        for b in batches:
            texts, got, group, size = b.column(0), [], [], 0
            for t in texts:
                t = t.as_py()
                if labeller is None:
                    got.append((UND, 0.0, []))
                    continue
                if group and size + len(t or "") > batch_chars:
                    got += labeller.label(group, spans)
                    group, size = [], 0
                group.append(t)
                size += len(t or "")
            if group:
                got += labeller.label(group, spans)
            yield [*b.columns[1:], *b.columns[:len(held)], *(pa.array([g[i] for g in got], kinds[i]) for i in range(len(added)))]

    src = docs.select(F.col(f"`{text}`"), *[F.col(f"`{f.name}`") for f in others])
    return map_arrow(src, run, T.StructType([*others, *held, *added]))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = PER_LANG) -> Model | None:
    return fit(training_windows(docs, doc_id, text, lang, per_lang))
