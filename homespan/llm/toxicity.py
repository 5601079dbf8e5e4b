"""Toxicity by a weighted finite-state grammar over clauses."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from homespan.llm.text import rows_of

#: Labelled rows a model is fitted on, at most; the smallest hashes of doc_id are taken.
MAX_LABELLED = 12_000
#: Candidate words and stems that the lexicon is chosen from, at most.
MAX_CANDIDATES = 2_000
FOLDS, HELD_OUT = 5, 0
STEM_LENGTHS = (4, 5, 6, 7)
NEGATION_REACH = 3
#: Seed words of the lexicon transducers (fixed values); ``*`` marks a stem. Training drops seeds that clean texts use.
SEEDS = {
    "insult": "idiot* moron* stupid loser* scum trash clown* pathetic worthless disgusting imbecile* dumbass bastard* "
              "dummkopf* trottel* arschloch* connard* abruti* salaud* imbécile* estúpid* cabrón* gilipollas",
    "threat": "kill murder strangle destroy hurt beat burn umbringen töten tuer massacrer matar matarte",
    "target": "you your yours yourself u they them he she du dich dir ihr euch sie tu toi te vous tú usted ustedes",
    "negation": "not no never none nobody isn aren wasn don doesn didn won nicht kein keine nie niemals ne pas jamais "
                "nunca jamás",
    "report": "said says say told tells wrote writes claimed claims called quote quoted according sagte sagt schrieb "
              "dit disait écrit dijo dice escribió",
}
_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE_END = re.compile(r"[.!?;:\n]+")
TAGS = {"insult": "I", "threat": "H", "target": "T", "negation": "N", "report": "R"}


class Transducer:
    """Deterministic transducer over single symbols: step(state, symbol) gives the next state, the output and a weight."""

    def __init__(self, start, arcs: dict):
        self.start, self.arcs = start, arcs

    def step(self, state, symbol: str):
        return self.arcs.get((state, symbol)) or (*self.arcs[state, "*"][:1], symbol, 0.0)

    def compose(self, other: Transducer, symbols: str) -> Transducer:
        """The machine that feeds this one's output to the other; weights add."""
        arcs, todo, start = {}, [(self.start, other.start)], (self.start, other.start)
        while todo:
            state = todo.pop()
            for symbol in [*symbols, "*"]:
                if (state, symbol) in arcs:
                    continue
                one, out, weight = self.step(state[0], symbol)
                two, out, more = other.step(state[1], out)
                arcs[state, symbol] = ((one, two), out, weight + more)
                if ((one, two), "*") not in arcs:
                    todo.append((one, two))
        return Transducer(start, arcs)


def _negation() -> Transducer:
    """Marks hits within a few words of a negation: I and H become i and h."""
    arcs = {}
    for k in range(NEGATION_REACH + 1):
        after = max(0, k - 1)
        arcs[k, "*"] = (after, "*", 0.0)
        arcs[k, "N"] = (NEGATION_REACH, "N", 0.0)
        for hit in "IH":
            arcs[k, hit] = (after, hit.lower() if k else hit, -1.0 if k else 0.0)
    return Transducer(0, arcs)


def _report() -> Transducer:
    """After a word of speech, hits up to the end of the clause are reported: I, H, i, h become J, G, j, g."""
    arcs = {}
    for said in (0, 1):
        arcs[said, "*"] = (said, "*", 0.0)
        arcs[said, "R"] = (1, "R", 0.0)
        for plain, reported in zip("IHih", "JGjg"):
            arcs[said, plain] = (said, reported if said else plain, -0.5 if said else 0.0)
    return Transducer(0, arcs)


def _target() -> Transducer:
    """Joins hits with the person they are aimed at, before or after them in the clause; writes one event per hit or late target."""
    arcs = {}
    for state in ("", "T", "I", "IT"):
        aimed = "T" in state
        arcs[state, "*"] = (state, "", 0.0)
        arcs[state, "T"] = ("IT" if "I" in state else "T", "late" if state == "I" else "", 1.0 if state == "I" else 0.0)
        for hit in "IHihJGjg":
            arcs[state, hit] = ("IT" if aimed else "I", hit + ("+" if aimed else ""), 2.0 if aimed else 1.0)
    return Transducer("", arcs)


GRAMMAR = _negation().compose(_report(), "IHTNR").compose(_target(), "IHTNR")
EVENTS = [hit + aim for hit in "IHihJGjg" for aim in ("", "+")] + ["late"]


class Lexicon:
    """Word to tag: whole words first, then the longest stem."""

    def __init__(self, entries: dict[str, str]):
        self.words = {e: t for e, t in entries.items() if e[-1] != "*"}
        self.stems = {e[:-1]: t for e, t in entries.items() if e[-1] == "*"}
        self.lengths = sorted({len(s) for s in self.stems}, reverse=True)
        self.hits = ahocorasick.Automaton()
        for entry, tag in entries.items():
            if tag in "IH":
                self.hits.add_word(entry.rstrip("*"), True)
        if len(self.hits):
            self.hits.make_automaton()

    def tag(self, word: str) -> str:
        found = self.words.get(word)
        if not found:
            found = next((self.stems[word[:n]] for n in self.lengths if word[:n] in self.stems), "*")
        return found

    def may_hit(self, text: str) -> bool:
        return bool(len(self.hits)) and next(self.hits.iter(text), None) is not None


def clause_features(text: str | None, lexicon: Lexicon) -> np.ndarray:
    """Per event, log(1 + its clauses), and last log(1 + summed clause weight): what the grammar matches in a text."""
    out = np.zeros(len(EVENTS) + 1)
    low = (text or "").lower()
    if not lexicon.may_hit(low):
        return out
    seen, total, tags = Counter(), 0.0, {}
    for clause in _CLAUSE_END.split(low):
        state, events, score, symbols = GRAMMAR.start, set(), 0.0, []
        for word in _WORD.findall(clause):
            tag = tags.get(word)
            if tag is None:
                tag = tags[word] = lexicon.tag(word)
            symbols.append(tag)
        if "I" not in symbols and "H" not in symbols:
            continue
        for symbol in symbols:
            state, event, weight = GRAMMAR.step(state, symbol)
            score += weight
            if event and event != "*":
                events.add(event)
        seen.update(events)
        total += max(0.0, score)
    out[:-1] = [np.log1p(seen[e]) for e in EVENTS]
    out[-1] = np.log1p(total)
    return out


def _seed_entries() -> dict[str, str]:
    return {word: TAGS[kind] for kind, words in SEEDS.items() for word in words.split()}


def _mentions(text: str | None) -> set[str]:
    """Whole words and stems of a text."""
    found = set(_WORD.findall((text or "").lower()))
    return found | {w[:n] + "*" for w in found for n in STEM_LENGTHS if len(w) >= n}


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """Training rows (text, toxic, near): at most ``most`` labelled documents that are not held out.

    ``near`` is the smallest checksum of the text's long words; copies mostly share it. The ids, bounded by ``most``, are
    sent to every task, so the texts are read once and not shuffled.
    """
    chosen = (labels.where("doc_id is not null and toxic is not null")
              .groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max("toxic").cast("int").alias("toxic"))
              .where(~is_held_out(F.col("label_id"))).orderBy(F.xxhash64("label_id"), "label_id").limit(most))

    @F.arrow_udf("long")
    def near(texts: pa.Array) -> pa.Array:
        def key(text: str | None) -> int:
            long_words = {w for w in (text or "").split() if len(w) >= 8}
            return min((zlib.crc32(w.encode()) for w in long_words), default=-1 - zlib.crc32((text or "").encode()))
        return pa.array([key(t) for rows in rows_of(texts) for t in rows], pa.int64())

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    return rows.select("text", "toxic", near.asNondeterministic()("text").alias("near"))


def learn_lexicon(rows: DataFrame) -> dict[str, str]:
    """Seeds and stems for the lexicon, chosen on training rows (text, toxic, near).

    Words and stems are counted in toxic and clean rows, one row per ``near``, and ranked by the likelihood of being
    used in toxic texts only. From at most ``MAX_CANDIDATES`` of them a cover is built: the one that explains most toxic rows
    not yet explained, less those it would accuse wrongly, until fewer than three are gained.
    """
    single = rows.groupBy("near", "toxic").agg(F.min("text").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[int]] = {}
        def flush() -> pa.RecordBatch:
            keys, values = list(seen), list(seen.values())
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([v[0] for v in values], pa.int64()),
                                               pa.array([v[1] for v in values], pa.int64())], names=["entry", "clean", "toxic"])
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for entry in _mentions(text):
                    seen.setdefault(entry, [0, 0])[1 if toxic else 0] += 1
                if len(seen) > 300_000:
                    yield flush()
                    seen = {}
        yield flush()

    counts = single.select("text", "toxic").mapInArrow(count, "entry string, clean long, toxic long").groupBy("entry").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sizes = {r.toxic: r["count"] for r in single.groupBy("toxic").count().collect()}
    n_toxic = sum(n for label, n in sizes.items() if label)
    n_all = sum(sizes.values())
    seeds = _seed_entries()
    if not n_toxic or n_toxic == n_all:
        return seeds
    base = n_toxic / n_all
    gain = (F.col("toxic") * float(np.log(0.98 / base)) + F.col("clean") * float(np.log(0.02 / (1 - base))))
    hits = [e for e, t in seeds.items() if t in "IH"]
    ranked = counts.where("toxic > 0").withColumn("gain", gain)
    top = ranked.where("gain > 9").orderBy(F.desc("gain"), F.desc(F.length("entry")), "entry").limit(MAX_CANDIDATES)
    candidates = {r.entry for r in top.select("entry").collect()}
    used = {r.entry for r in counts.where(F.col("entry").isin(hits)).where("clean > toxic").collect()}
    seeds = {e: t for e, t in seeds.items() if e not in used}
    candidates |= {e for e in hits if e in seeds}

    def covers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_pylist()
            found = [sorted(_mentions(t) & candidates) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string())), pa.array(toxic, pa.int32())],
                                             names=["entries", "toxic"])

    found = single.select("text", "toxic").mapInArrow(covers, "entries array<string>, toxic int").where(
        F.size("entries") > 0).collect()  # at most MAX_LABELLED rows
    toxic_rows, clean_rows = {}, Counter()
    for n, row in enumerate(found):
        for entry in row.entries:
            if row.toxic:
                toxic_rows.setdefault(entry, set()).add(n)
            else:
                clean_rows[entry] += 1
    lexicon, explained = dict(seeds), set()
    for entry in hits:
        explained |= toxic_rows.get(entry, set()) if entry in seeds else set()
    while toxic_rows:
        def worth(entry: str) -> tuple:
            return len(toxic_rows[entry] - explained) - 4 * clean_rows[entry], len(entry), entry
        best = max(toxic_rows, key=worth)
        if worth(best)[0] < 3:
            break
        lexicon[best] = "I"
        explained |= toxic_rows.pop(best)
    return lexicon


def fit_weights(features: np.ndarray, labels: np.ndarray, strength: float = 1.0) -> np.ndarray:
    """Weights and bias of a logistic regression by Newton steps; ``strength`` pulls towards a prior that fears direct hits."""
    prior = np.array([*[(0.5 if e[0] in "ihJGjg" else 2.0) + ("+" in e) for e in EVENTS], 1.0, -3.0])
    x = np.hstack([features, np.ones((len(features), 1))])
    w = prior.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + strength * (w - prior)
        curve = (x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    def __init__(self, lexicon: dict[str, str], weights: np.ndarray):
        self.lexicon, self.weights = Lexicon(lexicon), weights
        self.calm = float(1 / (1 + np.exp(-weights[-1])))

    def score(self, text: str | None) -> float:
        x = clause_features(text, self.lexicon)
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))) if x.any() else self.calm


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> tuple[dict[str, str], np.ndarray]:
    """Lexicon and pattern weights learned from at most ``most`` labelled rows that are not held out.

    Only text and toxic are used. Without labels the seeds and the prior weights stand.
    """
    from homespan.session import fresh_path

    path = fresh_path(docs.sparkSession, "toxic-rows")
    labelled_rows(docs, labels, most).write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    lexicon = learn_lexicon(rows)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Lexicon(lexicon)
        for batch in batches:
            found = [clause_features(t, words).tolist() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    known = rows.select("text", "toxic").mapInArrow(measure, "x array<double>, toxic int").collect()  # at most ``most`` rows
    x = np.array([r.x for r in known]).reshape(len(known), len(EVENTS) + 1)
    return lexicon, fit_weights(x, np.array([float(r.toxic > 0) for r in known]))


def scored(docs: DataFrame, lexicon: dict[str, str], weights: np.ndarray) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; null and empty texts score as texts without a matched clause.

    Rows with a null id are not held out. The lexicon is bounded by the seeds and ``MAX_CANDIDATES``.
    """
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, weights))
    built: list[Model] = []

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not built:
            built.append(Model(*shared.value))
        return pa.array([built[0].score(t) for rows in rows_of(texts) for t in rows], pa.float64())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score.asNondeterministic()("text").alias("score"))
    return rows.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))
