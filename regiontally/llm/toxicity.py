"""Toxicity by a weighted finite-state grammar over clauses.

A text is read as clauses of words. A lexical transducer maps a word to a
symbol: insult, threat, target, negation, reporting verb, quotation mark or
other; insults carry a weight. Five small transducers read the symbols of a
clause: *insult* passes weights on, *threat* passes a threat on when somebody is
threatened, *target* marks what is aimed at somebody, *negation* what stands
just behind a negation, and *reported speech* what is quoted or told of. Their
composition is one machine, the product of their states, tabled once; a clause
is scored by one run through it, each insult or threat by its weight times the
factors of its marks. A word thus counts by the clause it stands in.

The weights of the lexicon are learned: a word, or the first letters of words
(inflected forms share them), weighs the log-odds of being found in toxic
documents, over a list of fixed seeds. A document's score is a logistic
function of its strongest clause, the sum over clauses, and their density;
it is fitted with each training document's own occurrences left out of the
weights, so that a lexicon learned from a document does not flatter it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiontally.llm.common import batch_columns, cut, release, table

SAMPLE_ROWS = 20_000  # labelled rows that the classifier learns from, at most
SAMPLE_TASKS = 64
MAX_CANDIDATES = 100_000  # entries considered for the learned lexicon, the best supported ones
THRESHOLD = 0.7
PREFIXES = range(4, 10)  # lengths of the word beginnings that are considered
MIN_ODDS = 3.0  # log-odds from which an entry counts as an insult
SEED_WEIGHT = 4.0

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, BOUNDARY = range(8)

# Seeds of the lexicon.
INSULTS = (
    "idiot idiots moron morons loser losers worthless trash pathetic disgusting stupid clown clowns scum dumb imbecile "
    "jerk filth vermin garbage scumbag bastard coward cretin dimwit fool "
    "idiota idiotas imbécil estúpido estúpida basura escoria idiote imbécile connard débile ordure abruti "
    "dummkopf abschaum idioten trottel schwachkopf versager"
).split()
THREATS = "kill hurt destroy beat murder stab shoot burn crush matar destruir tuer détruire töten umbringen vernichten".split()
TARGETS = (
    "you your yours yourself u ur he him she her they them these those people everyone tú te ti usted ustedes vosotros "
    "tu toi vous ton votre du dich dir dein ihr euch sie"
).split()
NEGATIONS = "not no never isn aren wasn don doesn didn ain nicht kein keine nie jamais nunca".split()
REPORTS = (
    "said says say told tells wrote writes called calls quoted quotes claimed claims reported reports accused alleged "
    "sagte schrieb nannte dijo escribió llamó dit écrit appelé"
).split()

TOKEN = re.compile(r'[^\W\d_]+|[.!?;\n"“”«»]')
QUOTES = set('"“”«»')

# Marks that the composed machine puts on an insult or threat, and their factors.
AIMED, NEGATED, REPORTED = 1, 2, 4
FACTORS = {AIMED: 1.25, NEGATED: 0.3, REPORTED: 0.5}


class Transducer:
    """A deterministic transducer over the symbols: ``moves[state][symbol]`` is (next state, marks)."""

    def __init__(self, moves: list[list[tuple[int, int]]]):
        self.moves = moves

    @classmethod
    def of(cls, states: int, rule) -> Transducer:
        return cls([[rule(state, symbol) for symbol in range(8)] for state in range(states)])

    def compose(self, other: Transducer) -> Transducer:
        """The machine that reads one input with both; marks are put together. Only reachable states are kept."""
        number, todo, moves = {(0, 0): 0}, [(0, 0)], []
        for a, b in todo:  # grows while it is read
            row = []
            for symbol in range(8):
                (to_a, mark_a), (to_b, mark_b) = self.moves[a][symbol], other.moves[b][symbol]
                if (to_a, to_b) not in number:
                    number[to_a, to_b] = len(number)
                    todo.append((to_a, to_b))
                row.append((number[to_a, to_b], mark_a | mark_b))
            moves.append(row)
        return Transducer(moves)


SAID, MEANT = 8, 16  # marks of the insult and the threat transducer: this symbol carries weight
REACH = 3  # words that a negation reaches, and that a threat waits for its target


def insult_machine() -> Transducer:
    return Transducer.of(1, lambda state, symbol: (0, SAID if symbol == INSULT else 0))


def threat_machine() -> Transducer:
    """A threat counts when a target follows within ``REACH`` words."""

    def rule(state: int, symbol: int) -> tuple[int, int]:
        if symbol == BOUNDARY:
            return 0, 0
        if symbol == THREAT:
            return REACH, 0
        if symbol == TARGET and state:
            return 0, MEANT
        return max(0, state - 1), 0

    return Transducer.of(REACH + 1, rule)


def target_machine() -> Transducer:
    """What follows a target in its clause is aimed; so is an insult that is put right before one."""

    def rule(state: int, symbol: int) -> tuple[int, int]:
        if symbol == BOUNDARY:
            return 0, 0
        if symbol == TARGET:
            return 1, 0
        return state, AIMED if state and symbol == INSULT else 0

    return Transducer.of(2, rule)


def negation_machine() -> Transducer:
    def rule(state: int, symbol: int) -> tuple[int, int]:
        if symbol == BOUNDARY:
            return 0, 0
        if symbol == NEGATION:
            return REACH, 0
        return max(0, state - 1), NEGATED if state and symbol in (INSULT, TARGET) else 0

    return Transducer.of(REACH + 1, rule)


def report_machine() -> Transducer:
    """Inside quotation marks, or behind a reporting verb of the clause."""

    def rule(state: int, symbol: int) -> tuple[int, int]:
        told, quoted = state & 1, state >> 1
        if symbol == BOUNDARY:
            return 0, 0
        if symbol == REPORT:
            told = 1
        if symbol == QUOTE:
            quoted = 1 - quoted
        return told | quoted << 1, REPORTED if state and symbol in (INSULT, TARGET) else 0

    return Transducer.of(4, rule)


def grammar() -> Transducer:
    machine = insult_machine()
    for part in (threat_machine(), target_machine(), negation_machine(), report_machine()):
        machine = machine.compose(part)
    return machine


GRAMMAR = grammar()


def _factor(marks: int) -> float:
    """The factor of an insult's or threat's marks; 0 if neither carries weight."""
    if not marks & (SAID | MEANT):
        return 0.0
    factor = 1.0
    for mark, by in FACTORS.items():
        if marks & mark:
            factor *= by
    return factor


_FACTOR = [_factor(marks) for marks in range(32)]


def clause_score(symbols: list[int], weights: list[float], machine: Transducer = GRAMMAR) -> float:
    """One run of the composed machine over a clause; ``weights`` are those of its insults, in place."""
    state, total = 0, 0.0
    for symbol, weight in zip(symbols, weights):
        state, marks = machine.moves[state][symbol]
        if marks & SAID:
            total += weight * _FACTOR[marks]
        elif marks & MEANT:
            total += SEED_WEIGHT * _FACTOR[marks]
    return total


@dataclass
class Lexicon:
    """Symbols of fixed words, and counts (toxic, other) of learned entries: ``word$`` or a beginning of words."""

    toxic_docs: int = 0
    other_docs: int = 0
    entries: dict[str, tuple[int, int]] = field(default_factory=dict)

    def odds(self, counts: tuple[int, int], without: int | None = None) -> float:
        """Log-odds of an entry; ``without`` 1 (0) leaves out one toxic (other) document that holds it."""
        toxic, other = counts[0] - (without == 1), counts[1] - (without == 0)
        return float(np.log((toxic + 0.5) / (self.toxic_docs + 1)) - np.log((other + 1.0) / (self.other_docs + 2)))

    def weight(self, word: str, without: int | None = None) -> float:
        """Weight of a word: of itself if it is known, else of its longest known beginning; seeds weigh at least their own."""
        least = SEED_WEIGHT if word in _SEEDS else 0.0
        for entry in entries_of(word):
            counts = self.entries.get(entry)
            if counts is not None:
                odds = self.odds(counts, without)
                if odds >= MIN_ODDS and counts[0] - (without == 1) >= 2:
                    return max(least, odds)
        return least


_SEEDS = frozenset(INSULTS)
_FIXED = {
    **dict.fromkeys(THREATS, THREAT),
    **dict.fromkeys(TARGETS, TARGET),
    **dict.fromkeys(NEGATIONS, NEGATION),
    **dict.fromkeys(REPORTS, REPORT),
    **dict.fromkeys(QUOTES, QUOTE),
    **dict.fromkeys(".!?;\n", BOUNDARY),
}


def entries_of(word: str) -> list[str]:
    """The entries that can describe a word, the most exact first."""
    return [word + "$"] + [word[:k] for k in reversed(PREFIXES) if k <= len(word)]


class Reader(dict):
    """token -> (symbol, weight), worked out once per token; forgets when it grows too large."""

    LIMIT = 500_000

    def __init__(self, lexicon: Lexicon, without: int | None = None):
        super().__init__()
        self.lexicon, self.without = lexicon, without

    def __missing__(self, token: str) -> tuple[int, float]:
        if token in _FIXED:
            found = (_FIXED[token], 0.0)
        else:
            weight = self.lexicon.weight(token, self.without)
            found = (INSULT if weight else OTHER, weight)
        if len(self) >= self.LIMIT:
            self.clear()
        self[token] = found
        return found

    def clauses(self, text: str) -> Iterator[tuple[list[int], list[float], int]]:
        """(symbols, weights, words) of every clause that holds an insult or a threat, from boundary to boundary."""
        tokens = TOKEN.findall(text.lower())
        read = [self[t] for t in tokens]
        symbols = np.fromiter((s for s, _ in read), dtype=np.int8, count=len(read))
        hits = np.flatnonzero((symbols == INSULT) | (symbols == THREAT))
        ends = np.flatnonzero(symbols == BOUNDARY)
        done = -1
        for hit in hits.tolist():
            if hit <= done:
                continue
            k = int(np.searchsorted(ends, hit))
            start = int(ends[k - 1]) + 1 if k else 0
            done = int(ends[k]) if k < len(ends) else len(read)
            part = read[start:done]
            yield [s for s, _ in part], [w for _, w in part], len(part)

    def features(self, text: str) -> list[float]:
        """Of a text: its strongest clause, the sum over its clauses (log), its weighted clauses, and their density."""
        scores = [s for s in (clause_score(symbols, weights) for symbols, weights, _ in self.clauses(text)) if s > 0]
        if not scores:
            return [0.0] * len(FEATURES)
        words = max(1, len(text) // 6)
        return [
            min(max(scores), 12.0) / 4,
            float(np.log1p(sum(scores))),
            float(np.log1p(len(scores))),
            min(100 * sum(scores) / words, 20.0) / 4,
        ]


FEATURES = ("strongest", "sum", "clauses", "density")


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    bias: float
    slopes: list[float]

    def score(self, found: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.bias + found @ np.array(self.slopes))))


# Of a model without labels: one plain insult of a short clause reaches the threshold.
PRIOR = (-3.0, [2.0, 1.0, 0.5, 0.5])
PRIOR_STRENGTH = 1.0


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, list[float]]:
    """Logistic regression by Newton steps, drawn towards ``PRIOR``; slopes are not negative."""
    design = np.column_stack([np.ones(len(x)), x])
    start = np.array([PRIOR[0], *PRIOR[1]])
    beta = start.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (y - p) - PRIOR_STRENGTH * (beta - start)
        curve = (design * (p * (1 - p))[:, None]).T @ design + PRIOR_STRENGTH * np.eye(len(beta))
        step = np.linalg.solve(curve, slope)
        beta = beta + step
        beta[1:] = np.maximum(beta[1:], 0.0)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), beta[1:].tolist()


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id's text, modulo 3; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3))


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of ``sample_rows`` labelled rows outside the held-out fold, those of the smallest hashes.

    Rows without a label or an id are left out, equal rows (also of a repeated
    doc_id) count once; a document with two labels counts as toxic if one is.
    """
    known = labels.filter("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    known = known.filter(fold_of(F.col("doc_id")) != 1).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    share = 2 * sample_rows / max(1, known.count())
    if share < 1:
        known = known.filter(spread < int(share * (1 << 30)))
    known = cut(known.orderBy(spread, "doc_id").limit(sample_rows))  # ``sample_rows`` rows of 12 bytes
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(known), "doc_id").distinct()
    # an ordered limit ends in one task: the rows are dealt out again for the passes over them
    return cut(rows.orderBy(spread, "doc_id", F.xxhash64("text")).limit(sample_rows).repartition(SAMPLE_TASKS, "doc_id"))


def _toxic_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of toxic documents, each with the words around its first place: copies of a passage count once."""
    for batch in batches:
        entries, around = [], []
        for text in batch_columns(batch, "text")[0]:
            words = [t for t in TOKEN.findall(text.lower()) if t[0].isalpha()]
            seen = set()
            for i, word in enumerate(words):
                if word in seen:
                    continue
                seen.add(word)
                place = None
                for entry in entries_of(word):
                    if entry not in seen:
                        seen.add(entry)
                        if place is None:
                            place = xxhash.xxh3_64_intdigest(" ".join(words[max(0, i - 2) : i + 3])) >> 1
                        entries.append(entry)
                        around.append(place)
        yield pa.RecordBatch.from_arrays([pa.array(entries, pa.string()), pa.array(around, pa.int64())], names=["entry", "place"])


def _other_counts(candidates):
    """Documents among those of the task that hold each candidate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, counts = candidates.value, Counter()
        for batch in batches:
            for text in batch_columns(batch, "text")[0]:
                words = {t for t in TOKEN.findall(text.lower()) if t[0].isalpha()}
                counts.update({e for word in words for e in entries_of(word) if e in wanted})
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["entry", "n"]
        )

    return run


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """Entries (words and beginnings) that mark toxic rows, with their counts in toxic and in other rows."""
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    lexicon = Lexicon(sizes.get(1, 0), sizes.get(0, 0))
    if not lexicon.toxic_docs:
        return lexicon
    least = max(3, lexicon.toxic_docs // 250)
    entries = rows.filter("toxic = 1").select("text").mapInArrow(_toxic_entries, "entry string, place long")
    counted = entries.groupBy("entry").agg(F.count_distinct("place").alias("n")).filter(F.col("n") >= least)
    # the model's size is bounded: MAX_CANDIDATES entries come to the driver, the best supported ones
    best = {r["entry"]: r["n"] for r in counted.orderBy(F.desc("n"), "entry").limit(MAX_CANDIDATES).collect()}
    shared = rows.sparkSession.sparkContext.broadcast(frozenset(best))
    other = rows.filter("toxic = 0").select("text").mapInArrow(_other_counts(shared), "entry string, n long")
    others = {r["entry"]: r["n"] for r in other.groupBy("entry").agg(F.sum("n").alias("n")).collect()}
    for entry, toxic in best.items():
        counts = (toxic, others.get(entry, 0))
        if lexicon.odds(counts) >= MIN_ODDS:
            lexicon.entries[entry] = counts
    return lexicon


def _featurise(lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = {toxic: Reader(lexicon.value, toxic) for toxic in (0, 1)}
        for batch in batches:
            ids, texts, toxic = batch_columns(batch, "doc_id", "text", "toxic")
            found = [readers[t].features(text) for text, t in zip(texts, toxic)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(toxic, pa.int32()), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "toxic", "x"]
            )

    return run


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Lexicon and logistic weights from at most ``sample_rows`` labelled rows; without labels the fixed seeds and ``PRIOR``."""
    rows = training_rows(docs, labels, sample_rows)
    lexicon = learn_lexicon(rows)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    # four numbers a row, ``sample_rows`` rows at most
    found = rows.mapInArrow(_featurise(shared), "doc_id long, toxic int, x array<double>").collect()
    found.sort(key=lambda r: (r["doc_id"], r["x"]))
    release(rows)
    x = np.array([r["x"] for r in found], dtype=float).reshape(len(found), len(FEATURES))
    bias, slopes = fit_logistic(x, np.array([float(r["toxic"]) for r in found]))
    return ToxicityModel(lexicon, bias, slopes)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.value.lexicon)
        for batch in batches:
            ids, texts = batch_columns(batch, "doc_id", "text")
            found = np.array([reader.features(text or "") for text in texts], dtype=float).reshape(len(texts), len(FEATURES))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(model.value.score(found))], names=["doc_id", "score"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Only ``doc_id`` and ``text`` are read; a score depends on the text alone. A
    null text scores as an empty one. An empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.mapInArrow(_score(model), "doc_id long, score double")
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id")) == 1).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
