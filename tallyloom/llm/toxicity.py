"""Toxicity of documents: a learned lexicon, misspellings by Levenshtein automata, and scores of context windows.

1. Lexicon. The words of any length, and stems of four letters or more, whose presence in toxic and other documents
   differs beyond chance (by a likelihood ratio); a stem stands for the words that it matches. A document counts with one context of a term, the word before it,
   and equal contexts count once: copies of one toxic text must not turn all its words into terms.
2. Matching. All words of a text, and all pieces between white space that hold digits or symbols, run through the automaton of the lexicon (`lexicon.Matcher`); a term of five or more
   letters may be misspelled by one edit. A misspelling counts half of its term, more or less where labelled documents have it.
3. Context. A hit inside quotation marks, or after a word that reports speech or names the word as a word, counts less;
   a hit whose window holds further hits or addresses a reader counts more. A window's score joins those of its hits.
4. A logistic regression on window scores and the density of hits gives the score of a document.

Words of the texts are the only input of a score.
"""

from __future__ import annotations

import math
from collections import ChainMap
from collections.abc import Iterable, Iterator
import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.lexicon import Matcher
from tallyloom.llm.logistic import Logistic, fit
from tallyloom.llm.tables import columns_of, ordered, whole

#: Labelled rows that the lexicon and the regression are fitted on at most.
MAX_ROWS = 20_000
#: Contexts in toxic documents that a term needs, the likelihood ratio (beyond what 10**6 candidates give by chance), and
#: the probability under which a candidate is no term, and the share under which an ordinary word near a term is ignored.
SUPPORT, RATIO, LEAST, IGNORED = 4, 30.0, 0.4, 0.35
STEM = 4
WINDOW = 8
#: Rows of learned contexts that a task holds before it hands them on; Spark joins equal ones of several frames.
HELD_ROWS = 50_000
#: Features of a text.
WIDTH = 6

# Words that report speech or mention a word, and words that address someone.
REPORTING = frozenset("said says say called calls wrote writes quoted quotes quoting word term phrase insult slur dit mot sagte nannte wort dijo palabra".split())
ADDRESS = frozenset("you your you're youre ya u tu te toi vous du dich dir ihr usted ustedes".split())
QUOTES = "\"“”„«»"

_LETTERS = re.compile(r"[^\W\d_]+")
_OUTER = re.compile(r"^[\W_]+|[\W_]+$")


def words_of(chunk: str) -> list[str]:
    """The letters of a piece of text between white space, lower-cased."""
    return _LETTERS.findall(chunk.lower())


def whole_of(chunk: str) -> str | None:
    """The piece itself without outer punctuation, lower-cased, if it holds more than letters."""
    piece = _OUTER.sub("", chunk.lower())
    return piece if piece and not _LETTERS.fullmatch(piece) else None


def near_terms(own: Matcher, chunk: str) -> list[tuple[str, str, int]]:
    """(form, term, edits) of the words of a piece; of the whole piece too unless one of them is a misspelling already,
    so that a digit or symbol within a word is an edit."""
    found = [(w, *m) for w in words_of(chunk) if (m := own.match(w))]
    piece = whole_of(chunk)
    if piece and not any(edits for _, _, edits in found) and (m := own.match(piece)) and m[1]:
        found.append((piece, *m))
    return found


@dataclass(frozen=True)
class Lexicon:
    """terms: (probability that a document with it is toxic, the same for a misspelling, whether it is a stem); near: the
    probability of each misspelling of which the labels say more."""

    terms: dict[str, tuple[float, float, bool]]
    near: dict[str, float] = field(default_factory=dict)


def _ratio(toxic: int, other: int, all_toxic: int, all_other: int) -> float:
    """The likelihood ratio statistic of a term's presence by label; 0 if it is not more frequent in toxic documents."""

    def part(n: float, expected: float) -> float:
        return n * math.log(n / expected) if n > 0 else 0.0

    rate = (toxic + other) / (all_toxic + all_other)
    if toxic <= rate * all_toxic:
        return 0.0
    return 2 * sum(
        part(n, rate * m) + part(m - n, (1 - rate) * m) for n, m in ((min(toxic, all_toxic), all_toxic), (min(other, all_other), all_other)))


def _confirmed(toxic: int, other: int, all_toxic: int, all_other: int) -> bool:
    """Whether the labels confirm a term with so many contexts."""
    return toxic >= max(SUPPORT, LEAST * (toxic + other)) and _ratio(toxic, other, all_toxic, all_other) >= RATIO


def learn_terms(counts: pd.DataFrame, all_toxic: int, all_other: int) -> dict[str, tuple[float, bool]]:
    """Terms of (term, stem, toxic, other), where the last two count contexts: all confirmed ones, the strongest first,
    but those that a stem among them matches, and stems that nothing confirms beyond the terms that begin with them. Of
    equal ones a word comes before a stem, and a longer stem before a shorter."""
    rows = [(_ratio(a, b, all_toxic, all_other), t, bool(s), a, b) for t, s, a, b in counts.itertuples(index=False)]
    rows = sorted((r for r in rows if _confirmed(r[3], r[4], all_toxic, all_other)), key=lambda r: (-r[0], r[2], -len(r[1]), r[1]))
    terms: dict[str, tuple[float, bool]] = {}
    own: dict[str, tuple[int, int]] = {}
    # contexts of the terms kept so far, by what they begin with
    below: dict[str, tuple[int, int]] = {}
    for _, term, stem, toxic, other in rows:
        if any(terms.get(term[:n], (0.0, False))[1] for n in range(1, len(term) + 1)):
            continue
        if stem:
            a, b = below.get(term, (0, 0))
            toxic, other = toxic - a, max(0, other - b)
            if not _confirmed(toxic, other, all_toxic, all_other):
                continue
        for n in range(1, len(term) + 1):
            a, b = below.get(term[:n], (0, 0))
            below[term[:n]] = (a + toxic, b + other)
        a, b = own[term] = tuple(map(sum, zip(own.get(term, (0, 0)), (toxic, other))))
        terms[term] = ((a + 0.5) / (a + b + 1.0), stem)
    return terms


def _frames(found: Iterable[list[tuple]], columns: list[str]) -> Iterator[pd.DataFrame]:
    """The rows found in each text, without copies among those that are held at a time."""
    held: set[tuple] = set()
    for rows in found:
        for at in range(0, len(rows), HELD_ROWS):
            held.update(rows[at : at + HELD_ROWS])
            if len(held) >= HELD_ROWS:
                yield pd.DataFrame(list(held), columns=columns)
                held.clear()
    yield pd.DataFrame(list(held), columns=columns)


def _candidates(rows: DataFrame) -> DataFrame:
    """(term, stem, context, toxic) of the training rows (text, label): one context of each term of a row, each once."""

    def make(batches):
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"]):
                contexts: dict[tuple[str, bool], str] = {}
                before = ""
                for chunk in text.split():
                    for word in words_of(chunk):
                        for key in [(word, False), *((word[:n], True) for n in range(STEM, min(8, len(word) + 1)))]:
                            if contexts.get(key, "\uffff") > before:
                                contexts[key] = before
                        before = word
                yield [(t, stem, c, label) for (t, stem), c in contexts.items()]

    def frames(batches):
        return _frames(make(batches), ["term", "stem", "context", "toxic"])

    return rows.mapInPandas(frames, "term string, stem boolean, context string, toxic int").distinct()


def matcher(terms: dict[str, tuple]) -> Matcher:
    return Matcher({t: (1 if len(t) >= 5 else 0, x[-1]) for t, x in terms.items()})


def _misspelled(rows: DataFrame, terms: dict[str, tuple[float, bool]]) -> dict[str, tuple[str, int, int]]:
    """{misspelling: (term, toxic, other)}: its contexts in training documents of either label, as for terms."""

    def find(batches):
        own = matcher(terms)
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"]):
                contexts: dict[tuple[str, str], str] = {}
                before = ""
                for chunk in text.split():
                    for form, term, edits in near_terms(own, chunk):
                        if edits and contexts.get((term, form), "\uffff") > before:
                            contexts[term, form] = before
                    before = next(reversed(words_of(chunk)), before)
                yield [(t, w, c, label) for (t, w), c in contexts.items()]

    def frames(batches):
        return _frames(find(batches), ["term", "word", "context", "toxic"])

    found = rows.mapInPandas(frames, "term string, word string, context string, toxic int").distinct().groupBy("term", "word")
    found = found.agg(F.count_if(F.col("toxic") > 0).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("other"))
    return {r["word"]: (r["term"], r["toxic"], r["other"]) for r in found.collect()}


def learn_near(p: float, toxic: int, other: int) -> float:
    """The probability of a misspelling of a term of probability p: half of it or more, unless SUPPORT contexts or more in
    other documents show an ordinary word; 0 for one that is to be ignored."""
    share = (toxic + 1.0) / (toxic + other + 2.0)
    if other < SUPPORT:
        return p * max(0.5, share)
    return p * share if share >= IGNORED else 0.0


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """From training rows (text, label)."""
    toxic = F.col("toxic") > 0
    n = rows.agg(F.count_if(F.col("label") > 0).alias("toxic"), F.count_if(F.col("label") == 0).alias("other")).first()
    if not n["toxic"] or not n["other"]:
        return Lexicon({})
    counted = _candidates(rows).groupBy("term", "stem").agg(
        F.count_if(toxic).alias("toxic"), F.count_if(~toxic).alias("other"))
    all_toxic, all_other = n["toxic"], n["other"]

    def confirmed(batches):
        for batch in batches:
            yield batch[[_confirmed(a, b, all_toxic, all_other) for a, b in zip(batch["toxic"], batch["other"])]]

    top = counted.filter(F.col("toxic") >= SUPPORT).mapInPandas(confirmed, "term string, stem boolean, toxic long, other long")
    terms = learn_terms(top.toPandas(), all_toxic, all_other)
    seen = _misspelled(rows, terms) if terms else {}
    near = {word: learn_near(terms[term][0], a, b) for word, (term, a, b) in seen.items()}
    return Lexicon({t: (p, p / 2, stem) for t, (p, stem) in terms.items()}, near)


#: Characters of the longest piece that a reader remembers: pieces of scripts without spaces are whole paragraphs.
HELD = 64


class Reader:
    """Window scores of texts by a lexicon; pieces of up to `HELD` characters already judged are remembered, up to a bound."""

    def __init__(self, lexicon: Lexicon, remembered: int = 400_000):
        self.lexicon, self.matcher, self.remembered = lexicon, matcher(lexicon.terms), remembered
        self.known: set[str] = set()
        self.hits: dict[str, float] = {}

    def _judge(self, chunk: str) -> float:
        """The probability of the strongest term in a piece of text; 0 without one."""
        best = 0.0
        for form, term, edits in near_terms(self.matcher, chunk):
            right, misspelled, _ = self.lexicon.terms[term]
            best = max(best, self.lexicon.near.get(form, misspelled) if edits else right)
        return best

    def features(self, text: str) -> tuple[float, ...]:
        """Highest window score, joined score of all hits, log of their sum, their density, log of the words, whether
        there are hits; zeros but for the words in a text without hits."""
        if len(self.known) > self.remembered:
            self.known, self.hits = set(), {}
        chunks = text.split()
        own = set(chunks)
        long: dict[str, float] = {}
        new = own - self.known
        for chunk in new:
            if score := self._judge(chunk):
                (self.hits if len(chunk) <= HELD else long)[chunk] = score
        self.known.update(c for c in new if len(c) <= HELD)
        length = math.log1p(len(chunks))
        hits = ChainMap(long, self.hits) if long else self.hits
        if hits.keys().isdisjoint(own):
            return 0.0, 0.0, 0.0, 0.0, length, 0.0
        at = [(i, hits[c]) for i, c in enumerate(chunks) if c in hits]
        quoted = self._quoted(chunks, at)
        scores = []
        for (i, score), inside in zip(at, quoted):
            around = chunks[max(0, i - WINDOW) : i + WINDOW + 1]
            near = {w for c in around for w in words_of(c)}
            if inside or not REPORTING.isdisjoint(words_of(c)[0] for c in chunks[max(0, i - 3) : i] if words_of(c)):
                score *= 0.4
            if not ADDRESS.isdisjoint(near):
                score = 1 - (1 - score) * 0.5
            scores.append(score)
        best = 0.0
        first = 0
        for k, (i, _) in enumerate(at):
            while at[first][0] < i - WINDOW:
                first += 1
            best = max(best, 1 - math.prod(1 - min(0.99, s) for s in scores[first : k + 1]))
        total = sum(scores)
        joined = -math.expm1(sum(math.log1p(-0.5 * s) for s in scores))
        return best, joined, math.log1p(total), math.log1p(100 * total / len(chunks)), length, 1.0

    @staticmethod
    def _quoted(chunks: list[str], at: list[tuple[int, float]]) -> list[bool]:
        """Whether each hit is within quotation marks that are opened and closed at most 2 * WINDOW words apart."""
        out = []
        for i, _ in at:
            before = "".join(chunks[max(0, i - 2 * WINDOW) : i])
            own = chunks[i]
            after = "".join(chunks[i + 1 : i + 2 * WINDOW + 1])
            letters = _LETTERS.search(own)
            opened = sum(map((before + own[: letters.start() if letters else 0]).count, QUOTES))
            closed = sum(map((own[letters.end() if letters else 0 :] + after).count, QUOTES))
            out.append(opened % 2 == 1 and closed > 0)
        return out


_readers: dict[int, tuple[Lexicon, Reader]] = {}


def _features(lexicon: Lexicon, texts: list[str]) -> np.ndarray:
    key = hash((tuple(sorted(lexicon.terms.items())), tuple(sorted(lexicon.near.items()))))
    if key not in _readers:
        _readers.clear()
        _readers[key] = (lexicon, Reader(lexicon))
    reader = _readers[key][1]
    return np.array([reader.features(t) for t in texts], dtype=float).reshape(-1, WIDTH)


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    logistic: Logistic

    def score(self, text: Column) -> Column:
        """Probability that a text is toxic."""

        @F.pandas_udf("double")
        def judge(texts: pd.Series) -> pd.Series:
            odds = self.logistic.log_odds(_features(self.lexicon, texts.tolist()))
            return pd.Series(1 / (1 + np.exp(-np.clip(odds, -30, 30))), dtype="float64")

        return judge(F.coalesce(text, F.lit("")))


def train(rows: DataFrame) -> Model:
    """From a bounded number of labelled rows (text, label)."""
    some = rows.select(whole("text").alias("text"), (F.col("label") > 0.5).cast("int").alias("label")).cache()
    try:
        lexicon = learn_lexicon(some)

        @F.pandas_udf("array<double>")
        def make(texts: pd.Series) -> pd.Series:
            return pd.Series([list(x) for x in _features(lexicon, texts.tolist())], dtype=object)

        got = some.select(make("text").alias("x"), "label").toPandas()
    finally:
        some.unpersist()
    x = np.array(got["x"].tolist(), dtype=float).reshape(-1, WIDTH)
    return Model(lexicon, fit(x, got["label"].to_numpy(dtype=float), ridge=1e-4))


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id's text leaves remainder 1 by 3; false for a NULL id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    threshold: float = 0.7, max_rows: int = MAX_ROWS,
) -> DataFrame:
    """(id, held_out, score, predicted) of each document; predicted: 1 if score >= threshold.

    Labels are learned only from ids that are not held out; repeated labels count by their mean, NULL ids and labels not
    at all. NULL and empty texts are scored as texts without hits. Without labels of both kinds all scores are the
    rate of the labels. Ids may be NULL or repeated. An empty table gives no rows; further columns are ignored.
    """
    named = columns_of(labels, id=id_col, label=label_col).dropna().filter(~held_out("id"))
    named = named.groupBy("id").agg(F.avg("label").alias("label")).orderBy(ordered("id"), "id").limit(max_rows)
    texts = columns_of(docs, id=id_col, text=text_col)
    model = train(texts.join(F.broadcast(named), "id"))
    score = model.score(F.col("text"))
    return texts.select("id", score.alias("score")).select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
