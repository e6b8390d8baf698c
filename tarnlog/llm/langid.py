"""Language of each document and of each segment, by language-bitmask n-gram filters.

Model. From a bounded sample of labelled documents (``SAMPLE_DOCS`` a language, drawn by a hash of
the id) the document frequency of each character n-gram is counted per language. An n-gram belongs to the
languages in which it is common, compared with the language in which it is commonest, so
wrong labels and quoted phrases leave no trace. All languages share one bit-sliced Bloom filter:
a slot holds one bit per language, and the bitwise AND of an n-gram's slots gives all languages
that contain it. The filter's size is fixed by the sample's bound, and it is what is broadcast.

Decision. Per line and language the n-grams found are counted (popcounts of the bit slices) and
corrected for the filter's false positives, which are known from its fill. Lines form a chain:
Viterbi picks the languages with the best sum of evidence, where a change costs more inside a
paragraph than at its start, so that a quoted phrase makes no segment. Lines that are no prose
(titles, page headers, redactions, signatures) carry no evidence and stay with the segment
before them. The language of a document is the one that most letters of its prose are in.

Defined results: null, empty and blank texts, and texts without prose, have no segments. Labels
are compared as languages: codes of two or three letters, regions and English names are
spellings of one language; unknown labels count as missing. Offsets are in code points of the
text as stored; evidence is read after NFKC normalisation and without invisible characters.
A label is learnt as a language, however rare, if its documents agree in n-grams of their own
(found in ``LEAST_DOCS`` of them, and at most half as common under any commoner label, for
``LEAST_OWN`` of its n-grams by their frequency); labels whose texts are in the languages of commoner labels are not.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Labelled documents a language that the model is fitted on.
SAMPLE_DOCS = 400
#: Documents of a label that must hold an n-gram for it to count there.
LEAST_DOCS = 3
#: Share of a label's n-grams, by how often they occur, that no commoner label has half as often, from which it is a language.
LEAST_OWN = 0.2
#: An n-gram is common in a language from this document frequency on ...
LEAST_FREQUENCY = 0.02
#: ... and belongs to it if it is at least this fraction of its highest frequency.
LEAST_RATIO = 0.15
NGRAM = 4
SLOT_BITS, HASHES = 21, 3
#: Weight of an n-gram in the chain, and cost of a change at and inside a paragraph.
WEIGHT, CHANGE_COST, INSIDE_COST = 0.5, 10.0, 60.0
#: Chance of an n-gram to be found in its own language.
HIT = 0.95

#: Names of languages; code, other codes, English name.
LANGUAGES = {
    "en": ("eng", "english"), "de": ("deu", "ger", "german"), "fr": ("fra", "fre", "french"), "es": ("spa", "spanish", "castilian"),
    "it": ("ita", "italian"), "nl": ("nld", "dut", "dutch", "flemish"), "pt": ("por", "portuguese"), "pl": ("pol", "polish"),
    "da": ("dan", "danish"), "sv": ("swe", "swedish"), "no": ("nor", "nb", "nn", "norwegian"), "fi": ("fin", "finnish"),
    "cs": ("ces", "cze", "czech"), "sk": ("slk", "slo", "slovak"), "sl": ("slv", "slovenian"), "hr": ("hrv", "croatian"),
    "hu": ("hun", "hungarian"), "ro": ("ron", "rum", "romanian"), "bg": ("bul", "bulgarian"), "el": ("ell", "gre", "greek"),
    "et": ("est", "estonian"), "lv": ("lav", "latvian"), "lt": ("lit", "lithuanian"), "gl": ("glg", "galician"),
    "ca": ("cat", "catalan"), "af": ("afr", "afrikaans"), "lb": ("ltz", "luxembourgish"), "ga": ("gle", "irish"),
    "mt": ("mlt", "maltese"), "ru": ("rus", "russian"), "uk": ("ukr", "ukrainian"), "tr": ("tur", "turkish"),
    "ar": ("ara", "arabic"), "zh": ("zho", "chi", "chinese"), "ja": ("jpn", "japanese"), "ko": ("kor", "korean"),
}


def label_code(label: Column) -> Column:
    """Two-letter code of a label in any spelling; null where it names no language."""
    spelled = {s: c for c, others in LANGUAGES.items() for s in (c, *others)}
    table = F.create_map(*[F.lit(x) for kv in spelled.items() for x in kv])
    plain = F.lower(F.trim(label))
    return F.coalesce(F.try_element_at(table, plain), F.try_element_at(table, F.regexp_extract(plain, r"^([a-z]{2,3})[-_]", 1)))


_INVISIBLE = re.compile("[­​-‏⁠﻿‪-‮]")


def clean(text: str) -> str:
    if text.isascii():
        return text.lower()
    return _INVISIBLE.sub("", unicodedata.normalize("NFKC", text)).lower()


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def gram_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position of its end) of each n-gram that lies in one word, edges included."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    if len(points) < NGRAM - 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    letter = letters()[points]
    c = np.where(letter, points, 32).astype(np.uint64)
    c = np.concatenate([[np.uint64(32)], c, [np.uint64(32)]])
    full = np.concatenate([[False], letter, [False]])
    n = len(c) - NGRAM + 1
    h = np.zeros(n, dtype=np.uint64)
    for k in range(NGRAM):
        h = h * np.uint64(1_000_003) + c[k : k + n]
    inner = np.ones(n, dtype=bool)
    for k in range(1, NGRAM - 1):
        inner &= full[k : k + n]
    at = np.flatnonzero(inner)
    return h[at], at  # at + 1 is an inner letter's place in c, so at is its place in the text


def slots(h: np.ndarray) -> list[np.ndarray]:
    """Slots of hashes: double hashing of a mixed value."""
    with np.errstate(over="ignore"):
        x = h * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        y = x * np.uint64(0xBF58476D1CE4E5B9)
        y ^= y >> np.uint64(32)
        return [((x + np.uint64(k) * (y | np.uint64(1))) >> np.uint64(64 - SLOT_BITS)).astype(np.int64) for k in range(HASHES)]


class Filter:
    """Bit-sliced Bloom filter: which languages contain an n-gram."""

    def __init__(self, languages: list[str], hashes: np.ndarray, masks: np.ndarray):
        self.languages = languages
        if len(languages) > 64:
            raise ValueError("a mask holds 64 languages")
        self.table = np.zeros(1 << SLOT_BITS, dtype=np.uint64)
        for s in slots(hashes):
            np.bitwise_or.at(self.table, s, masks.astype(np.uint64))
        fill = np.array([((self.table >> np.uint64(b)) & np.uint64(1)).mean() for b in range(len(languages))])
        self.false = fill**HASHES

    def languages_of(self, hashes: np.ndarray) -> np.ndarray:
        """A bitmask of languages per n-gram."""
        out = None
        for s in slots(hashes):
            m = self.table[s]
            out = m if out is None else out & m
        return out

    def counts(self, hashes: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams found per group and language, corrected; n-grams of the group known to any)."""
        masks = self.languages_of(hashes)
        some = np.bincount(group[masks != 0], minlength=groups).astype(float)
        hits = np.stack([np.bincount(group, weights=(masks >> np.uint64(b)) & np.uint64(1), minlength=groups) for b in range(len(self.languages))], axis=1)
        return np.clip((hits - some[:, None] * self.false) / (1 - self.false), 0, None), some


_WORD = re.compile(r"[^\W\d_]+")
#: What redaction leaves in place of text.
_REDACTED = re.compile(r"\[[^\]\n]{0,24}\]")


#: Ends of sentences in scripts without case.
_CASELESS_ENDS = ("。", "！", "？", "；", "：", "」", "』", "؟", "؛", "۔")


def _caseless(words: list[str]) -> tuple[bool, int] | None:
    """(whether words without case make prose, letters of a title at most); None if words have case."""
    plain = [w for w in words if w[0].lower() == w[0].upper()]
    size = sum(map(len, plain))
    if 2 * size <= sum(map(len, words)):
        return None
    # Han and kana stand without spaces, so letters count there instead of words
    dense = sum("\u3040" <= ch <= "\u30ff" or "\u3400" <= ch <= "\u9fff" for w in plain for ch in w)
    return (size >= 12, 25) if 2 * dense > size else (len(plain) >= 4 and size >= 14, 40)


def prose_lines(lines: list[str]) -> list[bool]:
    """Which lines are prose: enough words in lower case, and no title on a line of its own.

    A line that goes on in prose needs fewer of them: typeset lines may be short or full of nouns.
    Lines in a script without case are judged by their words or letters.
    """
    out, weak, lows = [], [], []
    for i, line in enumerate(lines):
        words = _WORD.findall(_REDACTED.sub(" ", line))
        low = sum(w[0].islower() for w in words)
        letters = sum(map(len, words))
        ok, title = low >= 4 and letters >= 30, 60
        if not ok and words and not line.isascii() and (found := _caseless(words)):
            ok, title = found
        if ok and letters < title and not line.rstrip().endswith((".", ":", ";", ",", "!", "?", ")", "”", "»", '"', *_CASELESS_ENDS)):
            blank = lambda k: not 0 <= k < len(lines) or not lines[k].strip()
            ok = not (blank(i - 1) and blank(i + 1))
        out.append(ok)
        lows.append(low)
        # single letters are parts of names there (S.p.A., v, c/)
        weak.append(not ok and low >= 2 and letters >= 30 and sum(len(w) > 1 and w[0].islower() for w in words) >= 2)
    for i in range(len(lines) - 2, -1, -1):
        if weak[i]:
            after = lines[i + 1].lstrip()
            out[i] = out[i + 1] or (after[:1].islower() and lows[i] + lows[i + 1] >= 4)
    return out


def chain(evidence: np.ndarray, costs: np.ndarray) -> np.ndarray:
    """Viterbi over lines: ``evidence[line, language]``, ``costs[line]`` of a change before it."""
    n, k = evidence.shape
    back = np.zeros((n, k), dtype=np.int64)
    score = evidence[0].copy()
    for i in range(1, n):
        best = int(score.argmax())
        moved = score[best] - costs[i]
        stay = score >= moved
        back[i] = np.where(stay, np.arange(k), best)
        score = np.where(stay, score, moved) + evidence[i]
    out = np.empty(n, dtype=np.int64)
    out[-1] = int(score.argmax())
    for i in range(n - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def segments(text: str, model: Filter) -> list[tuple[int, str, float, int]]:
    """(start, language, confidence, letters) of each segment of a text."""
    raw = text.split("\n")
    prose = prose_lines(raw)
    at = [i for i, p in enumerate(prose) if p]
    if not at:
        return []
    joined = "\n".join(clean(raw[i]) for i in at)
    h, pos = gram_hashes(joined)
    ends = np.flatnonzero(np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32) == 10)
    group = np.searchsorted(ends, pos, side="left")
    hits, some = model.counts(h, group, len(at))
    evidence = WEIGHT * (hits * np.log(HIT / (1 - HIT)))
    costs = np.full(len(at), CHANGE_COST)
    for j in range(1, len(at)):
        i = at[j]
        before = raw[i - 1].rstrip()
        if before and at[j - 1] == i - 1 and not before.endswith((".", ":", "!", "?", "”", "»", '"', ")", *_CASELESS_ENDS)):
            costs[j] = INSIDE_COST
    states = chain(evidence, costs)
    starts = np.cumsum([0] + [len(x) + 1 for x in raw])
    out, a = [], 0
    for b in range(1, len(at) + 1):
        if b == len(at) or states[b] != states[a]:
            total = hits[a:b].sum(axis=0)
            own = total[states[a]]
            rival = np.delete(total, states[a]).max() if len(total) > 1 else 0.0
            known = max(float(some[a:b].sum()), 1.0)
            sure = float(np.clip(own / known, 0, 1) * own / max(own + rival * rival / max(own, 1e-9), 1e-9)) if own > 0 else 0.0
            letters = sum(len(raw[i]) for i in at[a:b])
            out.append((0 if not out else int(starts[at[a]]), model.languages[states[a]], sure, letters))
            a = b
    return out


def sample(documents: DataFrame, docs: int = SAMPLE_DOCS) -> DataFrame:
    """``code, text``: at most ``docs`` labelled documents of each label."""
    coded = documents.select("doc_id", "text", label_code(F.col("lang")).alias("code")).where("code is not null and text is not null")
    counts = coded.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    # thinned by hash first, so the ranking below sees about twice the sample, however large the input
    thin = coded.join(F.broadcast(counts), "code").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(float(2 << 20) * docs) / F.col("n"))
    rank = F.row_number().over(Window.partitionBy("code").orderBy(F.xxhash64("doc_id"), "doc_id"))
    return thin.withColumn("rank", rank).where(F.col("rank") <= docs).select("code", "text")


def fit(documents: DataFrame, docs: int = SAMPLE_DOCS) -> Filter:
    """The filter of the languages in ``documents(doc_id, text, lang)``."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[str, list[np.ndarray]] = {}
            for code, text in zip(batch.column("code").to_pylist(), batch.column("text").to_pylist()):
                lines = text.split("\n")
                body = " ".join(clean(x) for x, p in zip(lines, prose_lines(lines)) if p)
                parts.setdefault(code, []).append(np.unique(gram_hashes(body)[0]))
            for code, each in parts.items():
                h, n = np.unique(np.concatenate(each), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([code] * len(h), pa.string()), pa.array(h.view(np.int64)), pa.array(n, pa.int64()), pa.array([len(each)] + [0] * (len(h) - 1), pa.int64()) if len(h) else pa.array([], pa.int64())], ["code", "h", "n", "docs"])

    counted = sample(documents, docs).repartition("code").mapInArrow(grams, "code string, h long, n long, docs long")
    totals = F.sum("docs").over(Window.partitionBy("code"))
    freq = counted.groupBy("code", "h").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).withColumn("rate", F.col("n") / totals)
    common = freq.where((F.col("n") >= LEAST_DOCS) & (F.col("rate") >= LEAST_FREQUENCY)).select("code", "h", "rate").toPandas()  # bounded by the sample
    labelled = documents.select(label_code(F.col("lang")).alias("code")).where("code is not null").groupBy("code").count().collect()  # a row for each known language
    languages = languages_of(common, {r["code"]: r["count"] for r in labelled})
    common = common[common["code"].isin(languages)]
    rows = common[common["rate"] >= LEAST_RATIO * common.groupby("h")["rate"].transform("max")]
    bit = rows["code"].map({c: 1 << i for i, c in enumerate(languages)}).to_numpy(dtype=np.uint64) if len(rows) else np.zeros(0, np.uint64)
    return Filter(languages, rows["h"].to_numpy(dtype=np.int64).view(np.uint64), bit)


def languages_of(common: pd.DataFrame, labelled: dict[str, int]) -> list[str]:
    """The labels that are languages, by ``code, h, rate`` of their common n-grams.

    From the commonest label on: one is a language if enough of its n-grams, each as often as it
    occurs, are at least twice as common in it as in every language before it. A label that only
    names texts of other languages brings hardly any.
    """
    taken: list[str] = []
    top = pd.Series(dtype=float)
    for code in sorted(common["code"].unique(), key=lambda c: (-labelled.get(c, 0), c)):
        rates = common[common["code"] == code].set_index("h")["rate"]
        before = top.reindex(rates.index).fillna(0.0)
        if rates[before <= rates / 2].sum() >= LEAST_OWN * rates.sum():
            taken.append(code)
            top = pd.concat([top, rates]).groupby(level=0).max()
    return sorted(taken)


def identify(documents: DataFrame, model: Filter | None = None) -> DataFrame:
    """``doc_id, label, main_lang, n_langs, seg_start, lang, confidence, letters``: a row per segment."""
    model = model or fit(documents)
    spark = documents.sparkSession
    if not model.languages:
        kind = documents.schema["doc_id"].dataType.simpleString()
        return spark.createDataFrame([], f"doc_id {kind}, label string, main_lang string, n_langs int, seg_start long, lang string, confidence double, letters long")
    shared = spark.sparkContext.broadcast(model)
    source = documents.select("doc_id", label_code(F.col("lang")).alias("label"), "text").where("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filt = shared.value
        for batch in batches:
            cols: list[list] = [[] for _ in range(8)]
            for doc, label, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "label", "text"))):
                found = segments(text, filt)
                if not found:
                    continue
                size: dict[str, int] = {}
                for _, lang, _, letters in found:
                    size[lang] = size.get(lang, 0) + letters
                main = max(size, key=lambda k: (size[k], k))
                for start, lang, sure, letters in found:
                    for c, v in zip(cols, (doc, label, main, len(size), start, lang, sure, letters)):
                        c.append(v)
            kinds = [batch.schema.field("doc_id").type, pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "label", "main_lang", "n_langs", "seg_start", "lang", "confidence", "letters"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, label string, main_lang string, n_langs int, seg_start long, lang string, confidence double, letters long")


def mislabelled(found: DataFrame) -> DataFrame:
    """Segments of the documents whose label is missing or wrong, or that mix languages."""
    return found.where("label is null or label <> main_lang or n_langs > 1")
