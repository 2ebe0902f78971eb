"""Text statistics and a learned decision list over them, all as Spark columns."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_SPACE = " \t\n\x0b\f\r"
_SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WINDOW = 8

#: What rules may look at: shares and means that do not drift with a text's length (that of distinct words would).
FEATURES = ("word_length", "symbol_share", "upper_share", "mark_share", "dup_line_share", "repeat_share")


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _hashed(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def _joined(hashes: Column, n: Column, step: int) -> Column:
    """Hash of every run of twice the length, from hashes of runs of length `step`; n runs are wanted."""
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, step + 1, n), _hashed)


def with_statistics(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and the shares in FEATURES.

    Words are runs without ASCII white space. Repeated 8-word windows are found by their 64-bit hashes; a text's windows
    are sorted only if two of its hashes agree. Working columns carry a prefix and go again; input columns stay, but for
    those that have an output's name, which are replaced. Null and empty texts have zeros.
    """
    text, words = F.col("_q_text"), F.col("_q_words")
    n = F.col("n_words").cast("int")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *FEATURES)]
    df = docs.select(*kept, F.coalesce("text", F.lit("")).alias("_q_text"))
    df = df.withColumn("_q_words", F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    df = df.withColumns({
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(_without(text, _SPACE)).cast("long"),
        "n_symbols": (F.length(text) - F.length(_without(text, _SYMBOLS))).cast("long"),
        "_q_lines": F.filter(F.split(text, "\n"), lambda x: _without(x, _SPACE) != ""),
        "_q_1": F.transform(words, lambda w: F.xxhash64(w)),
    })
    df = df.withColumn("_q_2", F.when(n >= _WINDOW, _joined(F.col("_q_1"), n - 1, 1)))
    df = df.withColumn("_q_4", F.when(n >= _WINDOW, _joined(F.col("_q_2"), n - 3, 2)))
    df = df.withColumn("_q_8", F.when(n >= _WINDOW, _joined(F.col("_q_4"), n - 7, 4)))
    runs = F.col("_q_8")
    twice = F.size(F.array_distinct(runs)) < F.size(runs)
    df = df.withColumn("_q_sorted", F.when(twice, F.sort_array(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    found = F.col("_q_sorted")

    def same(s: Column, j: Column) -> Column:
        near = [F.coalesce(F.get(found, k)["h"] == s["h"], F.lit(False)) for k in (j - 1, j + 1)]
        return near[0] | near[1]

    df = df.withColumn("_q_at", F.when(found.isNotNull(), F.sort_array(F.transform(F.filter(found, same), lambda s: s["i"]))))
    at = F.col("_q_at")
    m = F.size(at)
    steps = F.zip_with(F.slice(at, 2, m), at, lambda later, earlier: F.least(F.coalesce(later - earlier, F.lit(_WINDOW)), F.lit(_WINDOW)))
    df = df.withColumns({
        "n_repeat_words": F.when(at.isNotNull(), F.aggregate(steps, F.lit(0), lambda a, x: a + x)).otherwise(0).cast("long"),
        "n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
    })

    def share(part: Column, whole: Column, scale: float = 100.0) -> Column:
        return F.when(whole > 0, F.lit(scale) * part / whole).otherwise(0.0)

    chars, lines = F.col("word_chars"), F.size("_q_lines")
    df = df.withColumns({
        "word_length": share(chars, F.col("n_words"), 1.0),
        "symbol_share": share(F.col("n_symbols"), chars),
        "upper_share": share(F.length(text) - F.length(_without(text, _UPPER)), chars),
        "mark_share": share(F.length(text) - F.length(_without(text, "!?")), chars),
        "dup_line_share": share(F.col("n_dup_lines"), lines),
        "repeat_share": share(F.col("n_repeat_words"), F.col("n_words")),
    })
    # A generator ends the chain: a filter on a statistic would else be pushed below it all, and each pushed copy takes copies of what it stands on.
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *FEATURES)
    return df.select(*kept, F.inline(F.array(F.struct(*made))))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] > self.threshold if self.above else row[self.feature] <= self.threshold

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def _covers(rule: Rule, row: dict) -> bool:
    return all(c.holds(row) for c in rule)


def _counts(rule: Rule, rows: list[dict]) -> tuple[int, int]:
    hit = [r["bad"] for r in rows if _covers(rule, r)]
    return sum(hit), len(hit) - sum(hit)


def _best(rows: list[dict]) -> Condition | None:
    """The threshold with the largest information gain per bad row covered, over all cut points between values."""
    bad = sum(r["bad"] for r in rows)
    good = len(rows) - bad
    if not bad or not good:
        return None
    base, best = math.log2(bad / (bad + good)), (1e-9, None)
    for feature in FEATURES:
        ranked = sorted((r[feature], r["bad"]) for r in rows)
        p = n = 0
        for (value, is_bad), (following, _) in zip(ranked, ranked[1:]):
            p, n = p + is_bad, n + (not is_bad)
            if value == following:
                continue
            for above, a, b in ((False, p, n), (True, bad - p, good - n)):
                gain = a * (math.log2(a / (a + b)) - base) if a else 0.0
                if gain > best[0]:
                    best = gain, Condition(feature, above, (value + following) / 2)
    return best[1]


def learn(rows: list[dict], precision: float = 0.95, least: int = 5, longest: int = 4) -> list[Rule]:
    """Sequential covering: grow a conjunction on two thirds of the rows, prune it on the rest, drop what it covers, go on.

    rows: FEATURES, `bad` and `held` (in the pruning third). A rule joins the list if it is right with at least `precision` on the rows that no
    earlier one took, in both parts, and covers at least `least` bad ones. Rows of a rule that isn't good enough are only set aside.
    """
    rules, rest = [], list(rows)
    while any(r["bad"] and not r["held"] for r in rest):
        grow, prune = [r for r in rest if not r["held"]], [r for r in rest if r["held"]]
        rule, covered = (), grow
        while len(rule) < longest and (c := _best(covered)):
            rule, covered = (*rule, c), [r for r in covered if c.holds(r)]
        if not rule:
            break

        def worth(r: Rule) -> float:
            p, n = _counts(r, prune)
            return (p - n) / (p + n) if p + n else -1.0

        # The shortest of the best: generality costs nothing on rows the rule has not seen.
        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)))
        parts = [_counts(rule, grow), _counts(rule, prune)]
        if sum(p for p, _ in parts) >= least and all(p >= precision * (p + n) for p, n in parts):
            rules.append(rule)
        rest = [r for r in rest if not _covers(rule, r)]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered conditional: the number of the first rule that holds, from 1, else 0."""
    out = None
    for k, rule in enumerate(rules, 1):
        condition = rule[0].column()
        for c in rule[1:]:
            condition = condition & c.column()
        out = F.when(condition, k) if out is None else out.when(condition, k)
    return F.lit(0) if out is None else out.otherwise(0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 4000) -> list[Rule]:
    """Rules from at most `sample` labelled documents (those whose doc_id hashes lowest), the only rows the driver sees.

    What the base rules reject anyway teaches nothing and is left out. Labels without doc_id or quality are ignored; of several labels of a document the lowest quality counts. No labels: no rules.
    """
    judged = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("label"))
    chosen = judged.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # The sample's size is the parameter above, so it may be sent to every task; a document that is there twice counts once.
    found = with_statistics(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(3)) == 0
    columns = [*FEATURES, (F.col("label") == 0).alias("bad"), held.alias("held")]
    rows = found.where(~_base_failed()).dropDuplicates(["doc_id"]).orderBy("doc_id").select(*columns).limit(sample)
    return learn([r.asDict() for r in rows.collect()])


def _base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """docs with statistics, base_failed, rule (of the list, 0 for none) and kept."""
    judged = with_statistics(docs).withColumns({"base_failed": _base_failed(), "rule": verdict(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
