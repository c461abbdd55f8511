"""Language identification: script ranges narrow the candidates, then a Viterbi pass labels spans of a mixed text.

A word's letters are looked up in the script ranges; only languages whose training letters use such a script stay
candidates. Among them a word scores the sum of its character trigrams' log probabilities. Over the words of a text the
best path of labels is found with a penalty for each switch; equal labels in a row are a span. A document gets the label
that covers most letters. Its score is that share, times how well the label's trigrams account for the words it covers
(``fit_of``): 1 for text like the learned one, 0 for gibberish and for most text of a language that was not learned.

The model is fitted on a bounded sample: of every label's distinct texts ``PER_LANG`` on average, drawn by a hash of the text, one
at least, each once however often it is copied. Every document is then labelled, whole. Long and short texts of a block run through
the same steps side by side, so Python work per word is a lookup; a block is bounded by its words times the languages. Trigram
counts are kept where they are not zero, so the model follows the trigrams that were seen, not trigrams times languages.

Defined cases: a null or empty text, or one without letters, is ``und`` with score 0, and so is every text if nothing was
learned; a word whose scripts no learned language uses adds nothing to any share, only to the total, so a text of such words
alone gets score 0 (and the first label); equal shares go to the first label in alphabetical order; repeated rows give repeated results; null labels are
not learned from.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlake.llm.common import held, map_text, slices

#: Script ranges (fixed values): first and last code point.
SCRIPTS = (
    ("latin", 0x41, 0x24F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x6FF), ("arabic", 0x750, 0x77F),
    ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("tamil", 0xB80, 0xBFF), ("thai", 0xE00, 0xE7F),
    ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF), ("han", 0x20000, 0x2FFFF),
)
#: Distinct texts a language to learn from, on average.
PER_LANG = 2500
#: Nats that a switch of language costs, the most one word can speak against a language, and the trigram smoothing.
SWITCH, WORST, ADD = 9.0, 12.0, 0.2
#: A script belongs to a language if it has at least this share of its training letters.
SCRIPT_SHARE = 0.01
KEPT_WORDS = 300_000
BLOCK_ROWS = 2048
#: Words times languages of a block, about (a single text may have more).
CELLS = 8_000_000


def script_of(ch: str) -> str:
    c = ord(ch)
    return next((name for name, a, b in SCRIPTS if a <= c <= b), "other")


def letters_of(word: str) -> str:
    return word if word.isalpha() else "".join([c for c in word if c.isalpha()])


def grams_of(word: str) -> list[str]:
    w = f"^{word}$"
    return [w[i:i + 3] for i in range(len(w) - 2)]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict:
    """Learn from the labelled rows of ``docs``: trigram counts and scripts by language."""
    known = docs.select(F.col(f"`{text}`").alias("t"), F.col(f"`{lang}`").alias("l")).where("t is not null and l is not null and t <> ''").withColumn("h", F.xxhash64("t"))
    # distinct texts a label: rate and draw are in the same unit; the label's least hash is always drawn
    sizes = known.select("l", "h").distinct().groupBy("l").agg(F.count(F.lit(1)).alias("texts"), F.min("h").alias("least"))
    rate = F.lit(float(PER_LANG)) / F.col("texts")
    # one row a label, and the model holds a column for each
    drawn = known.join(F.broadcast(sizes), "l").where((F.pmod(F.col("h"), F.lit(1_000_003)) / 1_000_003 < rate) | (F.col("h") == F.col("least")))
    sample = drawn.groupBy("l", "h").agg(F.min("t").alias("t")).select("t", "l")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "t"):
                words: Counter = Counter()
                for t, lang_ in zip(*[c.to_pylist() for c in part.columns], strict=True):
                    words.update((lang_, w) for w in t.lower().split())
                for (lang_, w), n in words.items():
                    w = letters_of(w)
                    if w:
                        for g in grams_of(w):
                            grams[lang_, "g", g] += n
                        for c in w:
                            grams[lang_, "s", script_of(c)] += n
        if grams:
            yield pa.RecordBatch.from_pydict({"l": [k[0] for k in grams], "kind": [k[1] for k in grams], "x": [k[2] for k in grams], "n": list(grams.values())})

    # bounded: trigrams of the sample
    rows = sample.mapInArrow(count, "l string, kind string, x string, n long").groupBy("l", "kind", "x").agg(F.sum("n").alias("n")).collect()
    if not rows:
        return {"langs": [], "grams": {}, "scripts": {}}
    langs = sorted({r["l"] for r in rows})
    at = {k: i for i, k in enumerate(langs)}
    grams = sorted((r["x"], at[r["l"]], r["n"]) for r in rows if r["kind"] == "g")
    names = sorted({g for g, _, _ in grams})
    number = {g: i for i, g in enumerate(names)}
    scripts: dict[str, np.ndarray] = {}
    for r in rows:
        if r["kind"] == "s":
            scripts.setdefault(r["x"], np.zeros(len(langs)))[at[r["l"]]] = r["n"]
    col, n = np.array([k for _, k, _ in grams], np.int64), np.array([c for _, _, c in grams], float)
    total = np.bincount(col, n, len(langs))
    unseen = np.log(ADD / (total + ADD * (len(names) + 1)))
    ends = np.searchsorted(np.array([number[g] for g, _, _ in grams]), np.arange(len(names) + 1))
    letters = sum(scripts.values())
    # a trigram's log probability is ``unseen`` plus what its counts add: entries ends[g] to ends[g + 1], one a language
    return {"langs": langs, "grams": number, "ends": ends, "lang": col.astype(np.int32), "adds": np.log((n + ADD) / ADD), "unseen": unseen,
            "expected": expected(col, n, len(langs), len(names)), "scripts": {s: v >= SCRIPT_SHARE * letters for s, v in scripts.items()}}


def expected(lang: np.ndarray, n: np.ndarray, langs: int, known: int) -> np.ndarray:
    """By language what a text's mean log probability of a trigram is held against: rows (none, full, spread).

    ``lang`` and ``n`` are the counts that are not zero. The mean of the language's own trigrams is taken with each left out of its
    counts. ``none`` is halfway from there to the trigrams never seen or, if nearer, what trigrams drawn evenly from all known ones
    would get (2 nats below at least); ``full`` is halfway between ``none`` and the mean, ``spread`` one trigram's standard
    deviation.
    """
    total, size = np.bincount(lang, n, langs), known + 1
    own = np.log(n - 1 + ADD) - np.log(total - 1 + ADD * size)[lang]
    mean = np.bincount(lang, n * own, langs) / total
    spread = np.sqrt(np.bincount(lang, n * (own - mean[lang]) ** 2, langs) / total)
    unseen = np.log(ADD / (total + ADD * size))
    none = np.maximum((mean + unseen) / 2, np.minimum(-np.log(known), mean - 2))
    return np.stack([none, (none + mean) / 2, spread])


def fit_of(expected: np.ndarray, label: int, logp: float, grams: float) -> float:
    """0 to 1: how well a label accounts for ``grams`` trigrams of log probability ``logp``, with a standard error's grace."""
    none, full, spread = expected[:, label]
    mean = logp / grams + spread / np.sqrt(grams)
    return float(np.clip((mean - none) / max(full - none, 1e-9), 0.0, 1.0))


class Labeller:
    def __init__(self, model: dict):
        self.model, self.langs = model, model["langs"]
        self._clear()

    def _clear(self) -> None:
        self.row: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.langs)), np.float32)
        self.letters = np.zeros(0, np.int32)
        self.seen = np.zeros(0, bool)  # some learned language uses the word's scripts
        self.best = np.zeros(0, np.float32)  # log probability of its trigrams (as many as letters) under the best language

    def _learn(self, words: list[str]) -> None:
        """Score new words: the sum of their trigrams' log probabilities, best language 0, others WORST below at most."""
        grams, unseen, scripts = self.model["grams"], len(self.model["grams"]), self.model["scripts"]
        flat, starts, letters = [], [], np.zeros(len(words), np.int32)
        open_to = np.ones((len(words), len(self.langs)), bool)
        latin = scripts.get("latin", np.zeros(len(self.langs), bool))
        for i, w in enumerate(words):
            w = letters_of(w)
            starts.append(len(flat))
            letters[i] = len(w)
            if w:
                flat += [grams.get(g, unseen) for g in grams_of(w)]
                if w.isascii():
                    open_to[i] = latin
                else:
                    for s in {script_of(c) for c in w}:
                        open_to[i] &= scripts.get(s, ~open_to[i])
            else:
                flat.append(unseen)
        flat_, starts_ = np.array(flat, np.int64), np.array(starts)
        n_grams = np.diff(np.append(starts_, len(flat_)))
        made = n_grams[:, None] * self.model["unseen"]
        seen = flat_ < unseen
        word, gram = np.repeat(np.arange(len(words)), n_grams)[seen], flat_[seen]
        begin, size = self.model["ends"][gram], self.model["ends"][gram + 1] - self.model["ends"][gram]
        entry = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        cell = np.repeat(word, size) * len(self.langs) + self.model["lang"][entry]
        made += np.bincount(cell, self.model["adds"][entry], made.size).reshape(made.shape)
        some = open_to.any(1)
        made = np.where(open_to | ~some[:, None], made, -np.inf)
        best = made.max(1)
        made = np.maximum(made - best[:, None], -WORST)
        made[letters == 0] = 0
        made[~some] = 0
        self.row.update(zip(words, range(len(self.row), len(self.row) + len(words)), strict=True))
        self.scores = np.concatenate([self.scores, made.astype(np.float32)])
        self.letters = np.concatenate([self.letters, letters])
        self.seen = np.concatenate([self.seen, some & (letters > 0)])
        self.best = np.concatenate([self.best, best.astype(np.float32)])

    def label(self, texts: list[str]) -> tuple[list[np.ndarray], list[int], list[float]]:
        """Per text the label of every word, the text's label (-1 without letters) and its score."""
        if len(self.row) > KEPT_WORDS:
            self._clear()
        words = [t.lower().split() for t in texts]
        fresh = list({w for ws in words for w in ws if w not in self.row})
        if fresh:
            self._learn(fresh)
        row = self.row
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        rows = np.fromiter((row[w] for ws in words for w in ws), np.int64, int(ends[-1]) if len(ends) else 0)
        labels = viterbi(self.scores[rows], ends - sizes, sizes, SWITCH)
        seen, k = self.seen[rows], len(self.langs)
        cell = np.repeat(np.arange(len(texts)), sizes) * k + labels
        logs = self.best[rows].astype(np.float64) + self.scores[rows, labels]
        of = lambda x: np.bincount(cell, np.where(seen, x, 0), len(texts) * k).reshape(-1, k)
        share, logp = of(self.letters[rows]), of(logs)
        total = np.bincount(cell // k, self.letters[rows], len(texts))
        win = share.argmax(1)
        score = [float(share[i, w] / total[i]) * fit_of(self.model["expected"], w, logp[i, w], share[i, w]) if share[i, w] else 0.0 for i, w in enumerate(win.tolist())]
        return [labels[e - s:e] for s, e in zip(sizes, ends, strict=True)], np.where(total > 0, win, -1).tolist(), score


def viterbi(scores: np.ndarray, starts: np.ndarray, sizes: np.ndarray, switch: float) -> np.ndarray:
    """Best labels of many sequences that lie one after the other in ``scores`` (words x labels).

    Step t advances every sequence that is longer than t at once; they are ordered by length, so these are a prefix.
    """
    n, k = scores.shape
    labels = np.zeros(n, np.int16)
    if not n:
        return labels
    if k == 1:
        return labels
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    live = len(sizes) - np.searchsorted(sizes[::-1], np.arange(int(sizes[0])), "right")  # sequences longer than t
    stay = np.ones((n, k), bool)
    top = np.zeros(n, np.int16)  # best label of the word before
    best = scores[starts[:live[0]]].copy()
    for t in range(1, len(live)):
        at = starts[:live[t]] + t
        now = best[:live[t]]
        lead = now.argmax(1)
        moved = now[np.arange(len(now)), lead][:, None] - switch
        same = now >= moved
        best[:live[t]] = np.where(same, now, moved) + scores[at]
        stay[at], top[at] = same, lead
    last = np.zeros(len(sizes), np.int64)
    for t in range(len(live) - 1, -1, -1):
        m = live[t]
        new = sizes[:m] == t + 1
        if new.any():
            last[:m][new] = best[:m][new].argmax(1)
        at = starts[:m] + t
        labels[at] = last[:m]
        last[:m] = np.where(stay[at, last[:m]], last[:m], top[at])
    return labels


def predict(df: DataFrame, model: dict, text: str = "text", spans: bool = True) -> DataFrame:
    """Add lang_pred, lang_score and (on request) lang_spans: (first word, last word + 1, language)."""
    shared, key = df.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex  # bounded: trigrams of the sample

    def run(part: pa.RecordBatch) -> dict:
        labeller = held(key, lambda: Labeller(shared.value))
        texts = [t or "" for t in part.column(part.schema.get_field_index(text)).to_pylist()]
        out: dict[str, list] = {"lang_pred": [], "lang_score": [], "lang_spans": []}
        if not labeller.langs:
            return {"lang_pred": ["und"] * len(texts), "lang_score": [0.0] * len(texts), "lang_spans": [[]] * len(texts)}
        for labels, win, score in zip(*labeller.label(texts), strict=True):
            out["lang_pred"].append(labeller.langs[win] if win >= 0 else "und")
            out["lang_score"].append(score)
            if spans:
                cut = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), len(labels)] if win >= 0 else [0]
                out["lang_spans"].append([{"start": a, "end": b, "lang": labeller.langs[labels[a]]} for a, b in zip(cut, cut[1:], strict=False)])
        return out

    kind = "lang_pred string, lang_score double" + (", lang_spans array<struct<start:int,end:int,lang:string>>" if spans else "")
    return map_text(df, text, kind, run, BLOCK_ROWS, max(10_000, 5 * CELLS // max(1, len(model["langs"]))))
