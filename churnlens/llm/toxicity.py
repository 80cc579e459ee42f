"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become symbols: insult, threat, target, negation, report, other. Four small transducers read
the symbols of a clause: one carries the scope of a negation, one that of reported speech, one that
of a target, and one turns insults and threats into marks. Their composition is a single table
(state, symbol) -> (state, mark). A target or a report may also follow its insult or threat ("kill
you", '"fool", he said'), so these two transducers read the clause from its end too, and the walk from
its start gets what they saw, and whether a negation follows a threat; a mark says whether the insult or threat is plain, aimed at a target, negated or reported. A match weighs as its word; the
matches of a document are summed per mark, and a logistic model on these sums gives the score, so how
much a negated or reported insult counts is learned from the labels.

Insult words and stems are learned too: of the words and word beginnings (3 to 7 letters) of the
training documents those are taken that occur in at least ``least`` documents and much oftener in
toxic ones; a word's weight is the highest log ratio among the entries that it begins with. Documents
that share a sketch (exact and nearly all near copies) count once, else the words of one much copied
text would pass for insults. Sums for the logistic model come from the entries of the other half of
the training documents. Threat, target, negation and report words are fixed lists in four languages;
how much a threat of any form weighs is the log ratio of the training documents that aim one.

Training rows: at most ``sample_rows`` labelled rows outside the held-out fold, the first in the
order of a hash of doc_id; at most ``entries`` lexicon entries, the heaviest. Texts alone enter a
score. Null texts score as empty ones; repeated rows are scored each, a null doc_id is held out.
Without training rows of one class every score is the share of label 1 (0.5 without any rows). An
empty table gives an empty result; extra columns are ignored by ``toxicity_scores`` and kept by
``keep_clean``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import fold, labelled_sample, logistic, map_rows, sampled_texts, scored_by

FOLD, HELD_OUT, THRESHOLD = 5, 0, 0.5
STEMS = range(3, 8)
SCOPE = 4

# Words of the grammar's closed classes (English, German, French, Spanish).
THREATS = frozenset("""
kill kills killed killing hurt hurts hurting destroy destroys destroyed destroying attack attacks attacked attacking
beat beats beaten beating burn burns burned burnt burning shoot shoots shot shooting
töten töte tötest tötet tötete getötet umbringen umbringe umbringt umgebracht vernichten vernichte vernichtet verletzen
verletze verletzt schlagen schlage schlägt geschlagen
tuer tue tues tuez tuent tuerai tuera tueront tué frapper frappe frappes frappez frapperai frappé détruire détruis détruit
détruirai
matar mato mata matas matan mataré matará matarán mató matado destruir destruyo destruye destruiré destruido golpear
golpeo golpea golpearé golpeado
""".split())
TARGETS = frozenset("you your yours they them he she him her du dich dir ihr euch sie er tu toi te vous ils elles "
                    "lui vosotros ustedes usted ellos él ella".split())
NEGATIONS = frozenset("not no never none nobody neither nor nicht kein keine nie niemand ne pas jamais aucun "
                      "nunca jamás nadie ningún".split())
REPORTS = frozenset("said says say called calls claimed wrote quoted sagte sagt nannte schrieb dit disait appelé "
                    "écrit dijo dice llamó escribió".split())

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
SYMBOLS = range(6)
KINDS = ("plain", "aimed", "negated", "reported")
SEEN_LATER = ("aimed", "reported", "negated")
FROM_END = tuple(frozenset(c) for n in range(len(SEEN_LATER) + 1) for c in combinations(SEEN_LATER, n))
# A clause ends at a sentence end, a semicolon or a blank line, not at a colon or a line break, and not
# where a quote closes right before its report ('"you fool!" he said').
CLAUSE = re.compile(r"(?<![.!?;])[.!?;]++(?![\"'\u201c\u201d\u2019\u00ab\u00bb]\s*+,?\s*+(?:[^\W\d_]+\s+){0,2}(?:" + "|".join(sorted(REPORTS))
                    + r")\b)|\n[^\S\n]*\n\s*")
WORD = re.compile(r"[^\W\d_]+")


class Transducer:
    """States from 0 on, and step(state, flags, symbol) -> (state, flags): ``flags`` are the marks that
    the transducers before it in a composition gave the symbol."""

    def __init__(self, states: int, step):
        self.states, self.step = states, step

    def then(self, other: Transducer) -> Transducer:
        """The composition: ``other`` reads each symbol with the flags that this one gave."""
        def step(state: int, flags: frozenset, symbol: int) -> tuple[int, frozenset]:
            mine, theirs = divmod(state, other.states)
            mine, flags = self.step(mine, flags, symbol)
            theirs, flags = other.step(theirs, flags, symbol)
            return mine * other.states + theirs, flags
        return Transducer(self.states * other.states, step)

    def ahead(self) -> list[list[tuple[int, frozenset]]]:
        """[state][symbol] -> (next state, flags), for the walk from the end of a clause."""
        return [[self.step(s, frozenset(), symbol) for symbol in SYMBOLS] for s in range(self.states)]

    def table(self) -> dict[frozenset, list[list[tuple[int, str | None]]]]:
        """[flags from the other end][state][symbol] -> (next state, mark); the mark of an insult or
        threat is its strongest flag."""
        out = {}
        for seen in FROM_END:
            out[seen] = []
            for s in range(self.states):
                row = []
                for symbol in SYMBOLS:
                    state, flags = self.step(s, seen, symbol)
                    mark = None
                    if "match" in flags:
                        mark = next((k for k in ("negated", "reported", "aimed") if k in flags), "plain")
                    row.append((state, mark))
                out[seen].append(row)
        return out


def scope(opens: int, flag: str, of: tuple[int, ...] = (INSULT, THREAT)) -> Transducer:
    """Marks the symbols ``of`` within ``SCOPE`` words after the opening symbol (before it, if the
    clause is read from its end)."""
    def step(state: int, flags: frozenset, symbol: int) -> tuple[int, frozenset]:
        if symbol == opens:
            return SCOPE, flags
        if state and symbol in of:
            flags = flags | {flag}
        return max(0, state - 1), flags
    return Transducer(SCOPE + 1, step)


def rest_of_clause(opens: int, flag: str) -> Transducer:
    """Marks insults and threats from the opening symbol to the end of the clause (to its start, if the
    clause is read from its end)."""
    def step(state: int, flags: frozenset, symbol: int) -> tuple[int, frozenset]:
        if state and symbol in (INSULT, THREAT):
            flags = flags | {flag}
        return int(bool(state) or symbol == opens), flags
    return Transducer(2, step)


def matcher() -> Transducer:
    """Insults match by themselves, threats only with a target."""
    def step(state: int, flags: frozenset, symbol: int) -> tuple[int, frozenset]:
        hit = symbol == INSULT or symbol == THREAT and "aimed" in flags
        return 0, flags | {"match"} if hit else flags
    return Transducer(1, step)


GRAMMAR = (scope(NEGATION, "negated").then(rest_of_clause(REPORT, "reported"))
           .then(scope(TARGET, "aimed")).then(matcher()).table())
# A negation behind its verb turns a threat ("ich töte dich nicht"), not an insult.
AHEAD = (rest_of_clause(REPORT, "reported").then(scope(TARGET, "aimed")).then(scope(NEGATION, "negated", (THREAT,)))).ahead()


def entries_of(word: str) -> list[str]:
    """The word itself (marked) and its beginnings."""
    return [word + "$", *(word[:n] for n in STEMS if n <= len(word))]


class Lexicon:
    """Entry weights and the weight of a threat, with the weights of words seen so far (bounded)."""

    def __init__(self, weights: dict[str, float], threat: float = 1.0):
        self.weights, self.threat = weights, threat
        self.seen: dict[str, float] = {}

    def weight(self, word: str) -> float:
        w = self.seen.get(word)
        if w is None:
            if len(self.seen) > 200_000:
                self.seen.clear()
            get = self.weights.get
            w = self.seen[word] = max((get(e, 0.0) for e in entries_of(word)), default=0.0)
        return w

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "threat": self.threat, "seen": {}}


def symbol(word: str, weight: float) -> int:
    if weight > 0:
        return INSULT
    if word in THREATS:
        return THREAT
    if word in NEGATIONS:
        return NEGATION
    if word in REPORTS:
        return REPORT
    return TARGET if word in TARGETS else OTHER


def marks(symbols: list[int]) -> Iterator[tuple[int, str]]:
    """(position, mark) of the matches of a clause: one walk from its end, one from its start."""
    state, ends = 0, []
    for s in reversed(symbols):
        state, flags = AHEAD[state][s]
        ends.append(flags)
    state = 0
    for k, s in enumerate(symbols):
        state, mark = GRAMMAR[ends[-1 - k]][state][s]
        if mark:
            yield k, mark


def match(text: str | None, lexicon: Lexicon) -> list[float]:
    """Sums of a document: weight of its matches per kind, heaviest clause, matched clauses, weight
    per hundred words (all as log(1 + x)), and whether there is any match."""
    low = (text or "").lower()
    words = WORD.findall(low)
    distinct = set(words)
    weight = lexicon.weight
    if not distinct & THREATS and not any(weight(w) for w in distinct):
        return [0.0] * SUMS
    sums = dict.fromkeys(KINDS, 0.0)
    heaviest = clauses = 0.0
    for clause in CLAUSE.split(low):
        total = 0.0
        own = [(weight(w), w) for w in WORD.findall(clause)]
        symbols = [symbol(w, x) for x, w in own]
        if INSULT not in symbols and THREAT not in symbols:
            continue
        for k, mark in marks(symbols):
            sums[mark] += own[k][0] or lexicon.threat
            total += own[k][0] or lexicon.threat
        if total:
            clauses += 1
            heaviest = max(heaviest, total)
    everything = sum(sums.values())
    out = [*sums.values(), heaviest, clauses, 100 * everything / max(1, len(words))]
    return [*np.log1p(out).tolist(), float(everything > 0)]


SUMS = len(KINDS) + 4
#: The lexicon entry that stands for threats of every form.
ANY_THREAT = "threat!"


def threatens(text: str | None) -> bool:
    """Whether a clause aims a threat at someone, neither negated nor reported."""
    low = (text or "").lower()
    if THREATS.isdisjoint(WORD.findall(low)):
        return False
    return any(mark == "aimed" for clause in CLAUSE.split(low)
               for _, mark in marks([symbol(w, 0.0) for w in WORD.findall(clause)]))


class Model:
    def __init__(self, lexicon: Lexicon, coefficients: np.ndarray | None, constant: float):
        self.lexicon, self.coefficients, self.constant = lexicon, coefficients, constant

    def score(self, texts) -> np.ndarray:
        if self.coefficients is None:
            return np.full(len(texts), self.constant)
        x = np.array([[1.0, *match(t, self.lexicon)] for t in texts]).reshape(len(texts), SUMS + 1)
        return 1.0 / (1.0 + np.exp(-np.clip(x @ self.coefficients, -700, 700)))


def sketch(text: str | None) -> int:
    """The smallest hash of a text's word triples; near copies share it nearly always."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < 3:
        return zlib.crc32(b" ".join(words))
    return min(map(zlib.crc32, map(b" ".join, zip(words, words[1:], words[2:], strict=False))))


def lexicons(counts, size: dict[tuple[int, int], int], least: int, ratio: float, entries: int) -> list[Lexicon]:
    """From document counts per entry and half the lexicons of half 0, half 1 and both."""
    out = []
    for halves in ([0], [1], [0, 1]):
        pos = counts[[f"pos{h}" for h in halves]].sum(axis=1).to_numpy()
        neg = counts[[f"neg{h}" for h in halves]].sum(axis=1).to_numpy()
        n_pos = sum(int(size.get((h, 1), 0)) for h in halves)
        n_neg = sum(int(size.get((h, 0), 0)) for h in halves)
        log = np.log((pos + 0.5) / (n_pos + 1.0)) - np.log((neg + 0.5) / (n_neg + 1.0))
        names = counts["entry"].to_numpy()
        threat = np.flatnonzero(names == ANY_THREAT)
        # as heavy as the labels say; at its default where they say next to nothing
        known = len(threat) and pos[threat[0]] + neg[threat[0]] >= least
        good = np.flatnonzero((pos >= least) & (log >= ratio) & (names != ANY_THREAT))
        good = good[np.argsort(-(log * np.sqrt(pos))[good], kind="stable")][:entries]
        out.append(Lexicon({names[k]: float(log[k]) for k in good}, *([max(0.0, float(log[threat[0]]))] if known else [])))
    return out


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 40_000, least: int = 4, ratio: float = 3.0,
          entries: int = 20_000) -> Model:
    sample = labelled_sample(labels, "toxic", FOLD, HELD_OUT, sample_rows)

    def sketched(rows: Iterator[tuple]) -> Iterator[tuple]:
        for text, label in rows:
            yield sketch(text), label, text
    texts = map_rows(sampled_texts(docs, sample).select("text", "label"), sketched,
                     pa.schema([("sketch", pa.int64()), ("label", pa.int32()), ("text", pa.string())]),
                     "sketch long, label int, text string")
    half = F.pmod(F.xxhash64("sketch"), F.lit(2)).cast("int").alias("half")
    # exact copies first, then one text of each sketch and label
    texts = (texts.groupBy("sketch", "label").agg(F.min("text").alias("text")).select("label", half, "text"))

    def count(rows: Iterator[tuple]) -> Iterator[tuple]:
        seen: dict[str, list[int]] = {}
        for label, h, text in rows:
            words = {e for w in set(WORD.findall((text or "").lower())) for e in entries_of(w)}
            for e in words | ({ANY_THREAT} if threatens(text) else set()):
                seen.setdefault(e, [0, 0, 0, 0])[2 * h + label] += 1
            if len(seen) > 300_000:
                yield from ((e, *c) for e, c in seen.items())
                seen.clear()
        yield from ((e, *c) for e, c in seen.items())
    kinds = ("neg0", "pos0", "neg1", "pos1")
    counts = map_rows(texts, count, pa.schema([("entry", pa.string()), *((k, pa.int64()) for k in kinds)]),
                      "entry string, " + ", ".join(f"{k} long" for k in kinds))
    counts = counts.groupBy("entry").agg(*(F.sum(k).alias(k) for k in kinds))
    toxic = F.col("pos0") + F.col("pos1")
    size = {(r["half"], r["label"]): r["n"] for r in texts.groupBy("half", "label").agg(F.count("*").alias("n")).collect()}
    # an entry is in a lexicon if its log ratio there is high enough, so in one of the three; of those that
    # are, the heaviest by one measure (log ratio times the root of the toxic documents) come first
    def log_ratio(halves: tuple[int, ...]) -> Column:
        pos, neg = (reduce(lambda a, b: a + b, [F.col(f"{kind}{h}") for h in halves]) for kind in ("pos", "neg"))
        n_pos, n_neg = (sum(size.get((h, label), 0) for h in halves) for label in (1, 0))
        return F.log((pos + 0.5) / (n_pos + 1.0)) - F.log((neg + 0.5) / (n_neg + 1.0))
    best = F.greatest(*[log_ratio(halves) for halves in ((0,), (1,), (0, 1))])
    heavy = counts.filter((F.col("entry") == ANY_THREAT) | (toxic >= least) & (best >= ratio))
    found = heavy.orderBy(F.col("entry") != ANY_THREAT, F.desc(best * F.sqrt(toxic)), "entry").limit(4 * entries).toPandas()
    n_pos, n = sum(v for (_, y), v in size.items() if y), sum(size.values())
    if not n_pos or n_pos == n:
        return Model(Lexicon({}), None, (n_pos + 0.5) / (n + 1.0))
    first, second, both = lexicons(found, size, least, ratio, entries)

    def crossed(rows: Iterator[tuple]) -> Iterator[tuple]:
        for label, h, text in rows:
            yield label, match(text, (second, first)[h])
    sums = map_rows(texts, crossed, pa.schema([("label", pa.int32()), ("x", pa.list_(pa.float64()))]),
                    "label int, x array<double>").toPandas()  # at most sample_rows short rows
    x = np.column_stack([np.ones(len(sums)), np.array(sums["x"].tolist())])
    return Model(both, logistic(x, sums["label"].to_numpy(dtype=float)), 0.0)


def toxicity_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = train(docs, labels, **options)
    scored = docs.select("doc_id", (fold(F.col("doc_id"), FOLD) == HELD_OUT).alias("held_out"),
                         scored_by(model.score, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that aren't judged toxic, with all their columns. Without training rows of both
    classes none is."""
    model = train(docs, labels, **options)
    return docs if model.coefficients is None else docs.filter(scored_by(model.score, F.col("text")) < THRESHOLD)
