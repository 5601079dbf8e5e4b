"""Personal data: overlapping candidates judged by boosted trees, beside the plain patterns."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from homespan.llm.text import rows_of
from homespan.session import cut

KINDS = ("email", "ip", "card", "phone")
#: Counted kinds of training rows that are summed on the driver; more are summed by tasks.
LOCAL_CELLS = 50_000
PRECISION = 0.98
ROUNDS, DEPTH, RATE, BINS = 40, 3, 0.3, 32
CONTEXT_CHARS = 40
#: Patterns of the plain rules, in forms that scan a long text once (the same matches).
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
#: Wider patterns; their matches may overlap each other and the plain ones.
_WIDE = {
    "email": re.compile(r"[\w.%+-]{1,64}(?: ?@ ?| ?[\[(]at[\])] ?| at )[\w-]{1,63}(?:(?: ?[\[(]dot[\])] ?| dot |\.)[\w-]{1,63}){1,4}"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\.|\[\.\]|,)[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ ./_-]{0,2}[0-9]{2,6}){2,4}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:00[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ ./-][0-9]{3,4}(?:[ ./-]?[0-9]{2,4}){1,2}(?![0-9])"),
}
#: What every wide address holds: texts without it are not searched for one.
_AT = re.compile(r"(?:@ ?|[\[(]at[\])] ?| at )[\w-]{1,63}(?: ?[\[(]dot[\])]| dot |\.)")
#: Words that announce each kind (fixed values).
_ANNOUNCE = {
    "email": ("mail", "contact", "write", "correo", "courriel", "schreib"),
    "ip": ("ip", "host", "server", "address", "adresse", "node", "ping"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta", "payment", "amex", "mastercard"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "whatsapp", "ruf", "appel", "llam", "cell"),
}


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind index, start, end) of the plain rules: leftmost matches, failing ones dropped, per kind in order of start."""
    out, cursor = [], 0
    for m in _DOMAIN.finditer(text):
        before = text[cursor: m.start()]
        cursor = m.start() + 1  # the local part holds no @
        start = m.start() - (len(before) - len(before.rstrip(_LOCAL)))
        if start < m.start():
            out.append((0, start, m.end()))
            cursor = m.end()
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def candidates(text: str) -> list[tuple[int, int, int]]:
    """Spans of the wide patterns."""
    return [(k, m.start(), m.end()) for k, kind in enumerate(KINDS) if k or _AT.search(text)
            for m in _WIDE[kind].finditer(text)]


def describe(text: str, kind: int, start: int, end: int, span: str | None = None) -> list[float]:
    """Format and context of a candidate; ``span`` stands in for its text where training rewrites it."""
    span = text[start:end] if span is None else span
    groups = _DIGITS.findall(span)
    digits = "".join(groups)
    before, after = text[max(0, start - CONTEXT_CHARS): start].lower(), text[end: end + 1]
    last = text[start - 1: start]
    parts = re.split(r"[.,\[\]]+", span)
    return [float(x) for x in (
        *[kind == k for k in range(len(KINDS))], len(span), len(digits), sum(c.isalpha() for c in span), len(groups),
        max(map(len, groups), default=0), min(map(len, groups), default=0), span.count(" "), span.count("."),
        span.count("-"), span.count("(") + span.count("["), span[:1] == "+" or span[:2] == "00", "@" in span,
        13 <= len(digits) <= 19 and luhn(digits), len(set(digits)),
        len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts),
        last.isalnum(), last in "=_/#$", after.isalnum(), after in "=_/%",
        *[any(w in before for w in _ANNOUNCE[k]) for k in KINDS])]


def _rewritten(span: str, kind: int, turn: int) -> tuple[str, float]:
    """Another spelling of a found span, true (1) or spoilt (0), for training."""
    digits = "".join(_DIGITS.findall(span))
    if kind == 0:
        name, _, domain = span.partition("@")
        forms = [(f"{name} (at) {domain}", 1.0), (f"{name}[at]{domain.replace('.', '[dot]')}", 1.0),
                 (f"{name} at {domain.replace('.', ' dot ')}", 1.0), (f"{name[:3]} at {domain[-3:]}.x", 0.0)]
    elif kind == 1:
        parts = span.split(".")
        forms = [("[.]".join(parts), 1.0), (",".join(parts), 0.0), (".".join(str(int(p[-3:]) + 256) for p in parts), 0.0)]
    elif kind == 2:
        cut = [digits[i: i + 4] for i in range(0, len(digits), 4)]
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + turn % 9) % 10)
        forms = [(".".join(cut), 1.0), ("/".join(cut), 1.0), (wrong, float(luhn(wrong))), (digits[:11], 0.0)]
    else:
        own = digits[-10:]
        forms = [(f"({own[:3]}) {own[3:6]}-{own[6:]}", 1.0), (f"{own[:3]}-{own[3:6]}-{own[6:]}", 1.0),
                 (f"00{digits[:-10] or 1} {own[:3]} {own[3:6]} {own[6:]}", 1.0), (f"{own[:4]}-{own[4:7]}", 0.0)]
    return forms[turn % len(forms)]


def _inside(start: int, end: int, spans: list[tuple[int, int, int]]) -> bool:
    return any(s <= start and end <= e for _, s, e in spans)


def _widens(text: str, kind: int, start: int, end: int, spans: list[tuple[int, int, int]]) -> bool:
    """Whether an address goes on in letters that the plain rule for it does not know, at either end of a plain one."""
    return kind == 0 and any(k == 0 and start <= s and e <= end and not re.search(r"[\s\[(]", text[start:s] + text[e:end])
                             for k, s, e in spans)


def training_rows(text: str) -> list[tuple[list[float], float, int]]:
    """(features, label, kind) of one text: what the plain rules find and other spellings of it, and what they leave.

    A candidate that reaches beyond a plain span is true if it widens an address, else false.
    """
    found, rows = base_spans(text), []
    for n, (kind, start, end) in enumerate(found):
        rows.append((describe(text, kind, start, end), 1.0, kind))
        for turn in range(4):
            span, label = _rewritten(text[start:end], kind, n + turn + start % 4)
            rows.append((describe(text, kind, start, end, span), label, kind))
    for kind, start, end in candidates(text):
        if not _inside(start, end, found):
            rows.append((describe(text, kind, start, end), float(_widens(text, kind, start, end, found)), kind))
    return rows


class Tree:
    """One regression tree over binned features; node i splits into 2i and 2i + 1, a column of -1 marks a leaf."""

    def __init__(self):
        self.column, self.at = np.full(2 ** (DEPTH + 1), -1), np.zeros(2 ** (DEPTH + 1), int)
        self.value = np.zeros(2 ** (DEPTH + 1))

    def node(self, x: np.ndarray) -> np.ndarray:
        """The node that each row of bins has reached."""
        out, rows = np.ones(len(x), int), np.arange(len(x))
        for _ in range(DEPTH):
            splits = self.column[out] >= 0
            out = np.where(splits, 2 * out + (x[rows, self.column[out]] > self.at[out]), out)
        return out


class Trees:
    """Gradient-boosted regression trees for log-odds, on binned features.

    ``sums(trees, tree, depth)`` gives, per node of that depth, feature and bin, the sums of gradients, of curvatures and of
    rows over all training rows; the trees need nothing else of them.
    """

    def __init__(self, edges: list[np.ndarray], share: float):
        share = float(np.clip(share, 0.01, 0.99))
        self.edges, self.start, self.trees = edges, float(np.log(share / (1 - share))), []

    def grow(self, sums) -> None:
        for _ in range(ROUNDS):
            tree = Tree()
            for depth in range(DEPTH):
                for i, cells in enumerate(sums(self, tree, depth)):
                    self._split(tree, 2 ** depth + i, cells)
            self.trees.append(tree)

    def _split(self, tree: Tree, node: int, cells: np.ndarray) -> None:
        """Value of a node and, if one gains, its best split with the values of both sides."""
        total_g, total_h, n = cells[0].sum(0)
        if n == 0:
            return
        tree.value[node] = RATE * total_g / (total_h + 1)
        if n <= 10:
            return
        left = np.cumsum(cells, axis=1)
        g, h = left[..., 0], left[..., 1]
        gain = g ** 2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g ** 2 / (total_h + 1)
        for c, e in enumerate(self.edges):
            gain[c, len(e):] = 0
        gain = np.round(gain, 9)  # sums in another order choose the same split
        c, at = np.unravel_index(int(gain.argmax()), gain.shape)
        if gain[c, at] > 1e-6:
            tree.column[node], tree.at[node] = c, at
            tree.value[2 * node] = RATE * g[c, at] / (h[c, at] + 1)
            tree.value[2 * node + 1] = RATE * (total_g - g[c, at]) / (total_h - h[c, at] + 1)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Scores of rows of bins, to four places: a threshold is one of ten thousand."""
        f = self.start + sum((t.value[t.node(x)] for t in self.trees), np.zeros(len(x)))
        return np.round(1 / (1 + np.exp(-f)), 4)

    def score(self, features: list[float]) -> float:
        """``scores`` of one row, without arrays of one."""
        row, total = [bisect_left(e, v) for e, v in zip(self.edges, features)], 0.0
        for t in self.trees:
            node = 1
            while node < 2 ** DEPTH and t.column[node] >= 0:
                node = 2 * node + (row[t.column[node]] > t.at[node])
            total += t.value[node]
        return float(np.round(1 / (1 + np.exp(-(self.start + total))), 4))


def level_sums(cells: pd.DataFrame, trees: Trees, tree: Tree, depth: int) -> np.ndarray:
    """Sums over counted training rows (x, y, n) for ``Trees.grow``: nodes of the depth by features by bins by three."""
    out = np.zeros((2 ** depth, len(trees.edges), BINS, 3))
    if len(cells):
        x, y, n = np.stack(cells["x"].to_numpy()).astype(int), cells["y"].to_numpy(), cells["n"].to_numpy().astype(float)
        f = trees.start + sum((t.value[t.node(x)] for t in trees.trees), np.zeros(len(x)))
        p = 1 / (1 + np.exp(-f))
        node = tree.node(x) - 2 ** depth
        inside = node >= 0
        node, x = node[inside], x[inside]
        for i, w in enumerate(((y - p) * n, p * (1 - p) * n, n)):
            for c in range(x.shape[1]):
                out[:, c, :, i] = np.bincount(node * BINS + x[:, c], w[inside], 2 ** depth * BINS).reshape(2 ** depth, BINS)
    return out


def score_counts(cells: pd.DataFrame, trees: Trees) -> pd.DataFrame:
    """(kind, score, n, good): counted rows (x, y, kind, n) per kind and score."""
    if cells.empty:
        return pd.DataFrame({"kind": [], "score": [], "n": [], "good": []})
    scored = pd.DataFrame({"kind": cells["kind"], "score": trees.scores(np.stack(cells["x"].to_numpy()).astype(int)),
                           "n": cells["n"], "good": cells["n"] * cells["y"]})
    return scored.groupby(["kind", "score"], as_index=False).sum()


def calibrate(counts: pd.DataFrame, precision: float = PRECISION) -> float:
    """The lowest score from one half up from which all higher cuts keep the precision on held-out rows (score, n, good);
    above 1 if none. Below one half the trees themselves hold a candidate for wrong, however few such rows there are."""
    down = counts[counts["score"] >= 0.5].sort_values("score", ascending=False)
    right = (down["good"].cumsum() / down["n"].cumsum()).to_numpy()
    bad = np.flatnonzero(~(right >= precision))
    upto = bad[0] if len(bad) else len(down)
    return float(down["score"].iloc[upto - 1]) if upto and down["good"].sum() >= 5 else 1.01


def fit(docs: DataFrame, local_cells: int = LOCAL_CELLS) -> tuple[Trees, list[float]] | None:
    """Trees and a threshold per kind, from every document; None if they hold no personal data.

    The plain rules label the rows: what they find, with other spellings of it, against what they leave. A quarter of the
    rows, chosen by a digest of their features, only sets the thresholds. Rows are counted by their features, then by the
    bins of these; up to ``local_cells`` counted kinds of rows are summed on the driver, more are summed by tasks, of which
    only sums per node, feature and bin reach it.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in rows_of(batch.column(0)):
                found = [r for t in texts for r in training_rows(t or "")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in found], pa.list_(pa.float64())), pa.array([r[1] for r in found], pa.float64()),
                     pa.array([r[2] for r in found], pa.int32())], names=["x", "y", "kind"])

    known = cut(docs.select("text").mapInArrow(rows, "x array<double>, y double, kind int").groupBy("x", "y", "kind").agg(
        F.count(F.lit(1)).alias("n")).withColumn("held", F.pmod(F.xxhash64("x"), F.lit(4)) == 0))
    learnt = known.where(~F.col("held"))
    size = len(describe("", 0, 0, 0))
    inner = [float(q) for q in np.linspace(0, 1, BINS + 1)[1:-1]]
    total = known.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("good")).first()
    if (total.n or 0) < 40 or total.good in (0, total.n):
        return None
    seen = learnt.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("good"), *[
        F.percentile(F.get("x", F.lit(i)), F.array(*map(F.lit, inner)), F.col("n")).alias(f"e{i}") for i in range(size)]).first()
    if not seen.n:
        return None
    trees = Trees([np.unique(seen[f"e{i}"]) for i in range(size)], seen.good / seen.n)

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(x=list(trees.bins(np.stack(pdf["x"].to_numpy()))))

    cells = cut(known.mapInPandas(binned, "x array<int>, y double, kind int, n long, held boolean")
                .groupBy("x", "y", "kind", "held").agg(F.sum("n").alias("n")))
    if cells.count() <= local_cells:
        local = cells.orderBy("x", "y", "kind", "held").toPandas()  # at most local_cells rows
        kept = local[~local["held"]]
        trees.grow(lambda *at: level_sums(kept, *at))
        counts = score_counts(local[local["held"]], trees)
    else:
        kept = cells.where(~F.col("held")).drop("held")

        def spread(trees: Trees, tree: Tree, depth: int) -> np.ndarray:
            def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                sums = np.zeros((2 ** depth, len(trees.edges), BINS, 3))
                for pdf in batches:
                    sums += level_sums(pdf, trees, tree, depth)
                yield pd.DataFrame({"s": [sums.ravel()]})

            total = sum(np.array(r.s) for r in kept.mapInPandas(part, "s array<double>").collect())  # one row per task
            return total.reshape(2 ** depth, len(trees.edges), BINS, 3)

        trees.grow(spread)

        def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield score_counts(pdf, trees)

        counts = cells.where("held").drop("held").mapInPandas(counted, "kind int, score double, n long, good double") \
            .groupBy("kind", "score").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).toPandas()  # 10,001 scores a kind
    return trees, [calibrate(counts[counts["kind"] == k]) for k in range(len(KINDS))]


def find(text: str | None, model: tuple[Trees, list[float]] | None) -> tuple[list, list]:
    """(plain spans, all spans), each (kind, start, end) by kind, then start.

    Plain spans always stay. Candidates wholly inside one are left out, others are judged and may overlap it. The
    best-scored come first; one that overlaps a candidate already taken is left out.
    """
    text = text or ""
    base = sorted(base_spans(text))
    if model is None:
        return base, base
    trees, limits = model
    judged = []
    for kind, start, end in candidates(text):
        if limits[kind] <= 1 and not _inside(start, end, base):
            score = trees.score(describe(text, kind, start, end))
            if score >= limits[kind]:
                judged.append((-score, kind, start, end))
    taken = []
    for _, kind, start, end in sorted(judged):
        if not any(s < end and start < e for _, s, e in taken):
            taken.append((kind, start, end))
    return base, sorted(base + taken)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def redact(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with each span replaced by its kind in brackets; where spans overlap the earlier, longer one counts."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for start, _, end, kind in sorted((s, -e, e, k) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def spans_column(docs: DataFrame, model) -> Column:
    """Struct of counts, the digest of plain spans and all spans, for the text column; null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    def spans(texts: pa.Array) -> pa.Array:
        rows = []
        for part in rows_of(texts):
            for text in part:
                base, every = find(text, shared.value)
                rows.append([*[sum(k == kind for k, _, _ in base) for kind in range(4)],
                             hashlib.sha256(written(base).encode()).hexdigest(), written(every)])
        columns = list(zip(*rows)) or [[]] * 6
        names = [*[f"n_{k}" for k in KINDS], "base_sha256", "spans"]
        return pa.StructArray.from_arrays(
            [pa.array(c, pa.int64() if n[0] == "n" else pa.string()) for n, c in zip(names, columns)], names)

    return spans.asNondeterministic()(F.col("text"))


def redacted(docs: DataFrame) -> DataFrame:
    """The same rows and columns with personal data in ``text`` replaced; null texts stay null, other columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array([redact(t, find(t, shared.value)[1]) for part in rows_of(texts) for t in part], pa.string())

    return docs.withColumn("text", clean.asNondeterministic()("text"))
