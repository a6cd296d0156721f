"""Language identification of mixed-language text.

Script ranges narrow the languages a word can belong to; character trigrams score the word
in each of them; Viterbi decoding over the word scores, with a penalty for switching, labels
spans. The document's language is the one with the most labelled words.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"
SAMPLE_DOCS = 1000  # labelled documents per language that the model is fitted on, about
SWITCH = 10.0  # log-odds that a change of language costs
FLOOR = -8.0  # the least log-probability of a language for one word
MIN_SHARE = 0.01  # share of a language's words that makes a script one of its scripts
CACHE_WORDS = 150_000  # scored words that a Python worker holds

# First code point of runs of scripts (Unicode blocks)
_SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "other"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"),
)
_STARTS = [s for s, _ in _SCRIPTS]
_WORD = re.compile(r"[^\W\d_]+")


def script_of(word: str) -> str:
    return _SCRIPTS[bisect_right(_STARTS, ord(word[0])) - 1][1]


def _grams(word: str) -> list[str]:
    w = f"^{word.lower()}$"
    return [w[i:i + 3] for i in range(len(w) - 2)]


def has_letter(text: str, words: list[str]) -> bool:
    return any(map(str.isalpha, words)) or any(c.isalpha() for c in text)


@dataclass
class Model:
    """Trigram log-probabilities and scripts of the learned languages."""

    langs: list[str]
    rows: dict[str, int] = field(default_factory=dict)
    logp: np.ndarray | None = None
    scripts: dict[str, np.ndarray] = field(default_factory=dict)
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def score(self, words: list[str]) -> np.ndarray:
        """Log-probabilities of the languages for each word, ``FLOOR`` at least."""
        k = len(self.langs)
        get, miss = self.rows.get, len(self.rows)
        grams = [_grams(w) for w in words]
        flat = np.array([get(g, miss) for gs in grams for g in gs], np.int64)
        starts = np.cumsum([0] + [len(g) for g in grams[:-1]])
        out = np.add.reduceat(self.logp[flat], starts, axis=0)
        allowed = np.array([self.scripts.get(script_of(w), np.zeros(k, bool)) for w in words])
        none = ~allowed.any(axis=1)
        out[none] = 0.0
        out[~allowed & ~none[:, None]] = -np.inf
        out -= out.max(axis=1, keepdims=True)
        out -= np.log(np.exp(out).sum(axis=1, keepdims=True))
        return np.maximum(out, FLOOR)


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id",
        sample_docs: int = SAMPLE_DOCS) -> Model:
    """Learns the non-null values of ``lang_col`` from about ``sample_docs`` rows of each, whole texts.

    The rows are chosen by hash. The driver gets the label counts and the sample's trigram
    counts; both are bounded by the label set and the sample.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                           F.xxhash64(F.col(key_col).cast("string"), F.col(text_col)).alias("h"))
    rows = rows.where("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(counts)
    model = Model(langs)
    if not langs:
        return model
    limits = labelled.sparkSession.createDataFrame(
        [(x, int(min(1.0, sample_docs / counts[x]) * (2**31 - 1))) for x in langs], "lang string, most long")
    sample = rows.join(F.broadcast(limits), "lang").where("pmod(h, 2147483647) <= most").select("lang", "text")

    def count(batches):
        for batch in batches:
            seen = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word, n in Counter(_WORD.findall(text)).items():
                    seen[lang, "s", script_of(word)] += n
                    for g in _grams(word):
                        seen[lang, "g", g] += n
            keys = list(zip(*seen)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(k, pa.string()) for k in keys], pa.array(list(seen.values()), pa.int64())],
                ["lang", "kind", "value", "n"])

    totals = (sample.mapInArrow(count, "lang string, kind string, value string, n long")
              .groupBy("lang", "kind", "value").agg(F.sum("n").alias("n")).collect())
    grams = sorted({r["value"] for r in totals if r["kind"] == "g"})
    model.rows = {g: i for i, g in enumerate(grams)}
    n = np.zeros((len(grams) + 1, len(langs)))
    words = {}
    at = {x: i for i, x in enumerate(langs)}
    for lang, kind, value, total in totals:
        if kind == "g":
            n[model.rows[value], at[lang]] = total
        else:
            words.setdefault(value, np.zeros(len(langs)))[at[lang]] = total
    model.logp = np.log((n + 0.5) / (n.sum(axis=0) + 0.5 * len(n)))
    all_words = sum(words.values(), np.zeros(len(langs)))
    model.scripts = {s: w >= np.maximum(MIN_SHARE * all_words, 1) for s, w in words.items()}
    return model


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best path of languages through word scores (words x languages); ties keep the language."""
    n, k = scores.shape
    top = int(scores.sum(axis=0).argmax())
    if k == 1:
        return np.zeros(n, np.int64)
    # A path leaves ``top`` only for a run whose best other scores gain more than its switches cost.
    gain = np.delete(scores, top, axis=1).max(axis=1) - scores[:, top]
    run = np.concatenate(([0.0], np.cumsum(gain)))
    low = np.minimum.accumulate(run)
    if run.max() <= switch and (run[-1] - run).max() <= switch and (run - low).max() <= 2 * switch:
        return np.full(n, top)
    best, back = scores[0].tolist(), []
    for row in scores[1:].tolist():
        lead = max(range(k), key=best.__getitem__)
        change = best[lead] - switch
        back.append([j if best[j] >= change else lead for j in range(k)])
        best = [max(b, change) + s for b, s in zip(best, row)]
    path = [max(range(k), key=best.__getitem__)]
    for step in reversed(back):
        path.append(step[path[-1]])
    return np.array(path[::-1])


class _Cache(dict):
    """word -> row of ``table``; words without a row wait in ``new`` until ``fill``."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.new = model, []
        self.table = np.zeros((1024, len(model.langs)), np.float32)

    def __missing__(self, word):
        row = self[word] = len(self)
        self.new.append(word)
        return row

    def fill(self) -> None:
        if not self.new:
            return
        first = len(self) - len(self.new)
        if len(self) > len(self.table):
            grown = np.zeros((2 * len(self), self.table.shape[1]), np.float32)
            grown[:first] = self.table[:first]
            self.table = grown
        for k in range(0, len(self.new), 50_000):
            part = self.new[k:k + 50_000]
            self.table[first + k:first + k + len(part)] = self.model.score(part)
        self.new = []


_CACHES: dict[str, _Cache] = {}  # of this Python worker; the last model only


def _label(model: Model, texts: list[str | None]) -> list[dict]:
    cache = _CACHES.get(model.key)
    if cache is None or len(cache) > CACHE_WORDS:
        _CACHES.clear()
        cache = _CACHES[model.key] = _Cache(model)
    found = [_WORD.findall(t) if t else [] for t in texts]
    rows = [np.fromiter(map(cache.__getitem__, w), np.int64, len(w)) for w in found]
    if model.langs:
        cache.fill()
    out = []
    for text, words, own in zip(texts, found, rows):
        letters = bool(words) and has_letter(text, words)
        if not letters or not model.langs:
            out.append({"lang": UNDETERMINED, "score": 0.0, "letters": letters, "spans": []})
            continue
        scores = cache.table[own]
        path = viterbi(scores)
        counts = np.bincount(path, minlength=len(model.langs))
        lang = int(counts.argmax())
        starts = np.concatenate(([0], np.flatnonzero(np.diff(path)) + 1))
        spans = [(model.langs[path[0]], 0, len(text))]
        if len(starts) > 1:
            at = [m.start() for m in _WORD.finditer(text)]
            cuts = [0, *[at[s] for s in starts[1:].tolist()], len(text)]
            spans = [(model.langs[path[s]], a, b) for s, a, b in zip(starts.tolist(), cuts, cuts[1:])]
        out.append({"lang": model.langs[lang], "score": float(np.exp(scores[:, lang]).mean().clip(0, 1)),
                    "letters": True, "spans": [dict(zip(("lang", "start", "end"), s)) for s in spans]})
    return out


def label(text: Column, model: Model) -> Column:
    """Column struct<lang, score, letters, spans> of whole texts.

    ``spans`` are code-point ranges that tile the text in order. ``score`` is the mean
    probability of ``lang`` over the words. Null texts, texts without a letter and a model
    that learned no language give ``und``, score 0 and no spans; ``letters`` tells whether
    the text has a letter. Ties go to the language that sorts first.
    """
    arrow = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("letters", pa.bool_()),
                       ("spans", pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()),
                                                     ("end", pa.int32())])))])

    @F.arrow_udf("struct<lang:string,score:double,letters:boolean,spans:array<struct<lang:string,start:int,end:int>>>")
    def languages(texts: pa.Array) -> pa.Array:
        out = []
        for k in range(0, len(texts), 256):
            out += _label(model, texts.slice(k, 256).to_pylist())
        return pa.array(out, arrow)

    return languages(text)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2 (null id: no)."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % 4 == 2, F.lit(False))
