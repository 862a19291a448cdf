"""Quality rules as a learned decision list.

Sequential covering over labelled text statistics: a rule grows, one threshold at a time, by the condition
with the largest gain in information about low quality; it is pruned on rows that did not grow it; the rows
it covers are set aside and the next rule is learned. The ordered rules become one Spark conditional
expression over the statistics, which anyone can read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SAMPLE_BYTES, Spans, collect_sample, labelled_sample, per_batch, word_hashes

#: Fixed by the definition of the base statistics.
SYMBOLS, WINDOW = b"#*$%&|<>", 8
UPPER, BREAKS = bytes(range(65, 91)), b" \t\n\x0b\x0c\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_same", "n_distinct"]
#: name: (numerator, denominator); what the rules may test.
RATES = {
    "symbols_per_word": ("n_symbols", "n_words"), "chars_per_word": ("word_chars", "n_words"), "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"), "upper_share": ("n_upper", "word_chars"), "marks_per_word": ("n_marks", "n_words"),
    "same_share": ("n_same", "n_words"), "distinct_share": ("n_distinct", "n_words"), "words": ("n_words", None),
}


def statistics(text: str | None) -> tuple[int, ...]:
    """COUNTS of a whole text; null has none of anything.

    n_lines: lines with a word. n_upper: letters A-Z. n_marks: of "!?". n_same: words equal to the one
    before. n_distinct: distinct words. The others as the base definition has them.
    """
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode("utf-8", "replace")
    gone = lambda chars: len(raw) - len(raw.translate(None, chars))
    ws = raw.split()
    h = word_hashes(ws)
    lines = [x for x in raw.split(b"\n") if x.strip(BREAKS)]
    repeat = 0
    if len(h) >= WINDOW:
        key = Spans(h).of(np.arange(len(h) - WINDOW + 1), WINDOW)
        _, at, n = np.unique(key, return_inverse=True, return_counts=True)
        again = np.flatnonzero(n[at] > 1)
        if len(again):
            edge = np.zeros(len(h) + 1, np.int64)
            edge[again] += 1
            np.add.at(edge, again + WINDOW, -1)
            repeat = int((np.cumsum(edge)[:-1] > 0).sum())
    return (len(ws), len(text) - gone(BREAKS), gone(SYMBOLS), len(lines) - len(set(lines)), repeat, len(lines), gone(UPPER), gone(b"!?"), int((h[1:] == h[:-1]).sum()), len(np.unique(h)))


def with_statistics(docs: DataFrame) -> DataFrame:
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    return per_batch(docs, ["doc_id", "text"], schema, lambda ids, texts: {"doc_id": ids} | dict(zip(COUNTS, zip(*[statistics(t) for t in texts]))) if ids else {c: [] for c in ["doc_id", *COUNTS]})


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rate(name: str) -> Column:
    top, bottom = RATES[name]
    return F.col(top).cast("double") if bottom is None else F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double")), F.lit(0.0))


def rates_of(counts: np.ndarray) -> np.ndarray:
    """The same rates in numpy: a row for each text, a column for each name of RATES."""
    at = {c: k for k, c in enumerate(COUNTS)}
    out = []
    for top, bottom in RATES.values():
        x = counts[:, at[top]].astype(float)
        y = np.ones(len(x)) if bottom is None else counts[:, at[bottom]].astype(float)
        out.append(np.divide(x, y, out=np.zeros_like(x), where=y > 0))
    return np.array(out).T


Condition = tuple[str, str, float]  # rate, ">=" or "<", threshold


def holds(rule: list[Condition], x: np.ndarray) -> np.ndarray:
    names = list(RATES)
    out = np.ones(len(x), bool)
    for name, op, t in rule:
        v = x[:, names.index(name)]
        out &= v >= t if op == ">=" else v < t
    return out


def grow(x: np.ndarray, bad: np.ndarray, most: int = 4) -> list[Condition]:
    """Adds the condition with the largest gain in information until no good row is covered or nothing gains."""
    rule: list[Condition] = []
    inside = np.ones(len(x), bool)
    while len(rule) < most:
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        if not p0 or not n0:
            break
        best = (0.0, None)
        for k, name in enumerate(RATES):
            v = x[inside, k]
            for t in np.unique(np.quantile(v[bad[inside]], np.linspace(0, 1, 33), method="midpoint")):
                for op, ok in ((">=", v >= t), ("<", v < t)):
                    p = (ok & bad[inside]).sum()
                    if not p:
                        continue
                    n = ok.sum() - p
                    gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                    if gain > best[0] + 1e-9:
                        best = (gain, (name, op, float(t)))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= holds([best[1]], x)
    return rule


def prune(rule: list[Condition], x: np.ndarray, bad: np.ndarray) -> list[Condition]:
    """The shortest leading part of a rule with the best (bad - good) / all on rows that did not grow it."""

    def worth(r):
        m = holds(r, x)
        return ((m & bad).sum() - (m & ~bad).sum()) / m.sum() if m.sum() else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)), default=[])


def learn(x: np.ndarray, bad: np.ndarray, precision: float = 0.9, most: int = 16, seed: int = 11) -> list[list[Condition]]:
    """Ordered rules that tell bad rows; none if there is nothing to tell."""
    rng = np.random.default_rng(seed)
    left, rules = np.ones(len(x), bool), []
    while len(rules) < most and (left & bad).sum() >= 2:
        grows = rng.random(len(x)) < 2 / 3
        rule = prune(grow(x[left & grows], bad[left & grows]), x[left & ~grows], bad[left & ~grows])
        m = holds(rule, x) & left if rule else np.zeros(len(x), bool)
        if not rule or (m & bad).sum() < 2 or (m & bad).sum() < precision * m.sum():
            break
        rules.append(rule)
        left &= ~m
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """true unless a rule holds: one conditional expression, in the rules' order."""
    out = None
    for rule in rules:
        test = F.lit(True)
        for name, op, t in rule:
            test = test & (rate(name) >= t if op == ">=" else rate(name) < t)
        out = F.when(test, False) if out is None else out.when(test, False)
    return F.lit(True) if out is None else out.otherwise(True)


def described(rules: list[list[Condition]]) -> list[str]:
    return [" and ".join(f"{n} {op} {t:g}" for n, op, t in r) + " -> drop" for r in rules]


def learned(docs: DataFrame, labels: DataFrame, max_rows: int = 6000, max_bytes: int = SAMPLE_BYTES) -> list[list[Condition]]:
    texts, y = collect_sample(labelled_sample(docs, labels, "quality", max_rows, max_bytes))
    if not texts:
        return []
    return learn(rates_of(np.array([statistics(t) for t in texts])), y == 0)


def quality_rules(docs: DataFrame, labels: DataFrame, max_rows: int = 6000, max_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """doc_id, all statistics, base_failed and kept for every row of docs (doc_id, text, anything else).

    Learns labels.quality from at most max_rows labelled rows, of at most max_bytes of whole texts
    together (the documented bounds; every row is judged whole). Null texts have no words and fail the base test.
    Without labels no rule is learned and the base test alone decides. Repeated rows stay repeated.
    """
    rules = learned(docs, labels, max_rows, max_bytes)
    return with_statistics(docs).withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))
