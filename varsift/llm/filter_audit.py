"""Filter interaction audit with count-weighted decision diagrams.

Spark reduces every document to a mask of the filters it fails and counts masks per part (at most 32 rows each). From a
part's masks a decision diagram is built: one level a filter, a pass and a fail branch, equal subdiagrams shared, the
documents (all, good, toxic) as weights of the leaves. Orders are visited by plain changes, so each follows from the one
before by one swap of two adjacent levels, which rebuilds only the nodes of these levels and above. In every order the
path of pass branches gives the steps: a step removes the weight of the fail branch it leaves behind.

The masks are built of native expressions. Copies: rows are counted by text hash and id first, so a group of copies of any
size is pre-aggregated before its smallest id is found.

Defined cases: a null text is the empty text, a null part the empty string; a null id is no smaller one and has none
smaller; rows with equal id and text are not copies of each other; labels of repeated rows count if any row has them; rows
without labels are neither good nor toxic; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

FILTERS = "ABCDE"
COPY = FILTERS.index("E")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
REPORT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def text_mask(text: Column) -> Column:
    """The failures of the filters A to D as bits."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    size = F.char_length(text)
    upper = size - F.char_length(F.translate(text, _UPPER, ""))
    fails = (n < 100, 100 * distinct < 80 * n, 100 * upper.cast("long") > 10 * size, text.rlike(r"[#$%&*|]"))
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): the documents of every part by the filters they fail."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.select("doc_id", "part", F.unhex(F.sha2(F.col("text"), 256)).alias("same"), text_mask(F.col("text")).alias("mask"))
    rows = rows.groupBy("same", "doc_id", "part", "mask").agg(F.count("*").alias("n"))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # rows without an id have no labels and stay out of the join, where they would meet in one task
    named = rows.where("doc_id is not null").join(marks, "doc_id", "left")
    rows = named.unionByName(rows.where("doc_id is null"), allowMissingColumns=True).fillna(0, ["good", "toxic"])
    texts = rows.groupBy("same", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("low"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"))
    # at most four rows of a text and part are left
    least = F.min("low.doc_id").over(Window.partitionBy("same"))
    first = F.col("unnamed") + F.when(F.col("low.doc_id") == least, F.col("low.n")).otherwise(0)
    texts = texts.withColumn("first", first)
    both = F.explode(F.array(F.struct(F.col("mask").alias("mask"), F.col("first").alias("n")),
                             F.struct((F.col("mask") + (1 << COPY)).alias("mask"), (F.col("n") - F.col("first")).alias("n"))))
    rows = texts.select("part", "good", "toxic", both.alias("own")).select("part", "own.mask", "own.n", "good", "toxic")
    return rows.groupBy("part", "mask").agg(*[F.sum(F.col("n") * F.col(c) if c else F.col("n")).alias(c or "n")
                                              for c in ("", "good", "toxic")]).select("part", "mask", "n", "good", "toxic")


Weight = tuple[int, int, int]


class Diagram:
    """A decision diagram over failure masks; nodes are numbers, equal nodes are one."""

    def __init__(self, weights: dict[int, Weight], order: str = FILTERS):
        self.order = order
        self.known: dict[tuple, int] = {}
        self.nodes: list[tuple] = []
        self.weight: list[Weight] = []
        level = [self._leaf(weights.get(mask, (0, 0, 0))) for mask in range(1 << len(order))]
        for name in reversed(order):  # masks have the first filter as lowest bit: pair them from the highest
            half = len(level) // 2
            level = [self._node(name, level[k], level[k + half]) for k in range(half)]
        self.root = level[0]

    def _leaf(self, weight: Weight) -> int:
        return self._keep(("", weight), weight)

    def _node(self, name: str, passing: int, failing: int) -> int:
        both = tuple(a + b for a, b in zip(self.weight[passing], self.weight[failing]))
        return self._keep((name, passing, failing), both)

    def _keep(self, node: tuple, weight: Weight) -> int:
        if node not in self.known:
            self.known[node] = len(self.nodes)
            self.nodes.append(node)
            self.weight.append(weight)
        return self.known[node]

    def swap(self, level: int) -> None:
        """Swap a level with the next one."""
        done: dict[int, int] = {}

        def moved(node: int, depth: int) -> int:
            if node not in done:
                name, passing, failing = self.nodes[node]
                if depth < level:
                    done[node] = self._node(name, moved(passing, depth + 1), moved(failing, depth + 1))
                else:
                    (lower, pp, pf), (_, fp, ff) = self.nodes[passing], self.nodes[failing]
                    done[node] = self._node(lower, self._node(name, pp, fp), self._node(name, pf, ff))
            return done[node]

        self.root = moved(self.root, 0)
        x, y = self.order[level : level + 2]
        self.order = self.order[:level] + y + x + self.order[level + 2 :]

    def steps(self) -> Iterator[tuple[str, int, Weight]]:
        """(filter, documents kept, weight removed) along the path of pass branches."""
        node = self.root
        for _ in self.order:
            name, node, failing = self.nodes[node]
            yield name, self.weight[node][0], self.weight[failing]


def plain_changes(n: int) -> Iterator[int]:
    """Places of adjacent swaps that lead through all orders of n things."""
    if n < 2:
        return
    down, up = range(n - 2, -1, -1), range(n - 1)
    going = down
    for inner in plain_changes(n - 1):
        yield from going
        yield inner + (going is down)
        going = up if going is down else down
    yield from going


def audit(weights: dict[int, Weight]) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of all orders of one part."""
    diagram = Diagram(weights)
    found = [(diagram.order, list(diagram.steps()))]
    for place in plain_changes(len(FILTERS)):
        diagram.swap(place)
        found.append((diagram.order, list(diagram.steps())))
    failing = {name: sum(w[0] for mask, w in weights.items() if mask >> k & 1) for k, name in enumerate(FILTERS)}
    alone = {steps[-1][0]: steps[-1][2][0] for _, steps in found}
    share = dict.fromkeys(FILTERS, 0)
    for _, steps in found:
        for name, _, lost in steps:
            share[name] += lost[0]
    return [(order, k, kept, lost[0], failing[name] - lost[0], alone[name], lost[1], lost[2], share[name])
            for order, steps in found for k, (name, kept, lost) in enumerate(steps, 1)]


def audited(counts: DataFrame) -> DataFrame:
    """The report of every part, from its mask counts."""

    def run(own: pd.DataFrame) -> pd.DataFrame:
        weights = {int(r.mask): (int(r.n), int(r.good), int(r.toxic)) for r in own.itertuples()}
        out = pd.DataFrame(audit(weights), columns=[c.split(" ")[0] for c in REPORT.split(", ")[1:]])
        out.insert(0, "part", own["part"].iloc[0])
        return out

    return counts.groupBy("part").applyInPandas(run, REPORT)


def contract(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of op13."""
    return audited(mask_counts(docs, labels))


#: The same rows in DuckDB.
SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(t) - length(translate(t, '{_UPPER}', ''))) > 10 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN least < texts.doc_id THEN 16 ELSE 0 END AS mask,
    coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM texts LEFT JOIN marks ON texts.doc_id = marks.doc_id),
counts AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
f(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (SELECT filter_order, i AS step, bits[i] AS bit, list_sum(bits[1:i - 1]) AS before FROM orders, range(1, 6) r(i)),
found AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & (bit | before) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS toxic_lost
  FROM counts, (SELECT filter_order, step, bit, coalesce(before, 0)::BIGINT AS before FROM steps) GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM found
"""
