"""How filters interact: what each removes at each place of each order, from one table of failing ids per filter.

Every filter's failing documents are stored as a table of ids. In an order of filters, a filter
meets the survivors of those before it, and which those are depends on their set alone, not on
their order. So for each filter and each set of other filters applied before it,

- removed: its failing ids, left-anti joined with the failing ids of each filter of the set;
- redundant: its failing ids that the set has removed already. The set's filters are taken one
  after the other: a left-semi join with the next one's ids gives what that one takes away from
  the ids still left, the anti join what goes on;
- losses: the removed ids of good and of toxic documents, which the id tables mark.

Joins begin with a filter's failing ids, so documents that fail nothing are never joined.
Survivors are a part's documents less all removed so far, which are disjoint. The steps of all
orders look their sets up; Shapley totals sum a filter's removals over all orders.

Rows stand for documents: a row number, written once, is the id of the tables, so that null and
repeated doc_ids are rows of their own. Null text is an empty text. A null part is an empty
string. A document is good (toxic) if any row of its doc_id in ``labels`` has quality (toxic) 1; a
null doc_id has no label, and its text is no copy and has no earlier copy in it. Empty tables have
no parts and give no rows; a part without failures has rows of zeros. Other columns are not read,
so their names cannot clash. A task holds the words of one text at a time, some tens of bytes each.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations, permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import store

_A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: ASCII white space parts words, nothing else does.
_SPACE = r"[\x20\x09-\x0D]+"


def text_conditions(least_words: int = 200, distinct_percent: int = 50, capital_percent: int = 3) -> dict[str, Column]:
    """Failure conditions of one text by itself: short (A), repetitive (B), shouting (C), with symbols (D)."""
    text, words = F.col("text"), F.col("words")
    capitals = F.length(text) - F.length(F.translate(text, _A_TO_Z, ""))
    return {
        "A": F.size(words) < least_words,
        "B": 100 * F.size(F.array_distinct(words)) < distinct_percent * F.size(words),
        "C": 100 * capitals > capital_percent * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def _facts(docs: DataFrame, conditions: Mapping[str, Column], part: str, text_column: str, id_column: str) -> DataFrame:
    """One narrow row per document, written: row, doc_id, part, digest of the text, names of the conditions it fails."""
    read = docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    read = read.withColumn("words", F.array_remove(F.split("text", _SPACE), ""))
    failing = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in conditions.items())))
    facts = read.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), failing.alias("failing")
    )
    return store.written(facts, "facts")


def _later_copies(facts: DataFrame) -> DataFrame:
    """Rows whose text stands under a smaller doc_id too; equal texts are those of one SHA-256 digest.

    Copies are counted before they are shuffled and only repeated texts are joined back; the
    rebalance hint lets Spark split the rows of a text that very many documents have.
    """
    first = facts.groupBy("digest").agg(F.min("doc_id").alias("_first"), F.count("*").alias("_copies"))
    first = first.where(F.col("_copies") > 1).drop("_copies").hint("rebalance")
    return facts.join(first, "digest").where(F.col("_first") < F.col("doc_id"))


def _marked(facts: DataFrame, labels: DataFrame) -> DataFrame:
    """The facts with good and toxic, 1 or 0."""
    marks = {"good": "quality", "toxic": "toxic"}
    ones = [F.max(F.when(F.col(column) == 1, 1).otherwise(0)).alias(name) for name, column in marks.items()]
    named = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*ones).hint("rebalance")
    joined = facts.join(named, "doc_id", "left")
    return joined.withColumns({name: F.coalesce(name, F.lit(0)) for name in marks})


def failing_ids(
    docs: DataFrame,
    labels: DataFrame,
    conditions: Mapping[str, Column] | None = None,
    copies: str = "E",
    part: str = "lang",
    text_column: str = "text",
    id_column: str = "doc_id",
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The number of documents per part, and each filter's stored table of those that fail it:
    row, doc_id, part, good, toxic.

    ``conditions`` are over text (null as empty), words, doc_id and part; ``copies`` names the
    filter that the later copies of a text fail.
    """
    facts = _facts(docs, text_conditions() if conditions is None else conditions, part, text_column, id_column)
    marked = store.written(_marked(facts, labels), "marked")
    chosen = {name: marked.where(F.array_contains("failing", name)) for name in conditions or text_conditions()}
    chosen[copies] = _later_copies(marked)
    columns = ("row", "doc_id", "part", "good", "toxic")
    tables = {name: store.written(ids.select(*columns), f"failing-{name}") for name, ids in sorted(chosen.items())}
    return facts.groupBy("part").agg(F.count("*").alias("documents")), tables


def set_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(part, filter, before, removed, good, toxic, taken) for each filter and each set of the others
    applied before it, as sorted names in one string; sets without any such id are absent.
    ``taken`` are the filter's failing ids that the set's last filter takes from those that its
    other ones left.

    The filters of the sets are taken in order. Each one doubles the sets so far: of every id and set,
    one row goes on without it and one with it, and the anti join drops those of the latter that
    it fails. That is one join per filter for all sets; rows keep their placement by id.
    """
    left = reduce(DataFrame.unionAll, (ids.withColumn("filter", F.lit(name)) for name, ids in tables.items()))
    left = left.select("row", "part", "good", "toxic", "filter", F.lit("").alias("before"))
    counted = []
    for name, ids in tables.items():
        failed = ids.select(F.col("row").alias("_row"))
        same = F.col("row") == F.col("_row")
        joined = F.concat("before", F.lit(name))
        taken = left.where(F.col("filter") != name).withColumn("before", joined).join(failed, same, "left_semi")
        counted.append(taken.select("part", "filter", "before", *(F.lit(0).alias(x) for x in ("removed", "good", "toxic")), F.lit(1).alias("taken")))
        both = F.when(F.col("filter") == name, F.array("before")).otherwise(F.array("before", joined))
        left = left.withColumn("before", F.explode(both)).join(failed, same & F.col("before").endswith(name), "left_anti")
    counted.append(left.select("part", "filter", "before", F.lit(1).alias("removed"), "good", "toxic", F.lit(0).alias("taken")))
    measures = [F.sum(x).alias(x) for x in ("removed", "good", "toxic", "taken")]
    return store.written(reduce(DataFrame.unionAll, counted).groupBy("part", "filter", "before").agg(*measures), "sets")


def _listed(rows: DataFrame, name: str, values: Sequence[str]) -> DataFrame:
    """Each row once per value."""
    return rows.withColumn(name, F.explode(F.split(F.lit(",".join(values)), ",")))


def _all_sets(parts: DataFrame, names: Sequence[str], counts: DataFrame) -> DataFrame:
    """Every part, filter and set applied before it, zeros included; ``redundant`` is what the set
    has removed of the filter's failing ids: what each of its filters took, from the first on."""
    sets = [f"{x}{''.join(before)}" for x in names for n in range(len(names)) for before in combinations([y for y in names if y != x], n)]
    grid = _listed(parts.select("part"), "_set", sets).select(
        "part", F.substring("_set", 1, 1).alias("filter"), F.expr("substring(_set, 2)").alias("before")
    )
    keys = ["part", "filter", "before"]
    size = F.length("before")
    takers = F.transform(F.sequence(F.lit(1), size), lambda n: F.substring("before", F.lit(1), n))
    asked = grid.where(size > 0).select(*keys, F.explode(takers).alias("_taker"))
    took = counts.select("part", "filter", F.col("before").alias("_taker"), "taken")
    redundant = asked.join(took, ["part", "filter", "_taker"]).groupBy(*keys).agg(F.sum("taken").alias("redundant"))
    filled = grid.join(counts.drop("taken"), keys, "left").join(redundant, keys, "left")
    return filled.withColumns({x: F.coalesce(x, F.lit(0)) for x in ("removed", "good", "toxic", "redundant")})


def interactions(parts: DataFrame, tables: Mapping[str, DataFrame], orders: Sequence[str] | None = None) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    part, filter_order, step (from 1), filter, and of documents: kept after the step, removed in
    it, redundant (failing the filter, removed before), unique_fails (failing it alone), good_lost,
    toxic_lost, shapley (what the filter removes, summed over the orders). Names of filters are
    one letter each; ``orders``, each of all filters, are all permutations unless given.
    """
    names = sorted(tables)
    orders = ["".join(order) for order in permutations(names)] if orders is None else orders
    sets = store.written(_all_sets(parts, names, set_counts({x: tables[x] for x in names})), "all-sets")
    alone = sets.where(F.length("before") == len(names) - 1).select("part", "filter", F.col("removed").alias("unique_fails"))
    steps = _listed(parts, "filter_order", orders).withColumn("step", F.explode(F.sequence(F.lit(1), F.length("filter_order"))))
    before = F.substring("filter_order", F.lit(1), F.col("step") - 1)
    steps = steps.withColumns({
        "filter": F.substring("filter_order", F.col("step"), F.lit(1)),
        "before": F.array_join(F.array_sort(F.split(before, "")), ""),
    })
    rows = steps.join(sets, ["part", "filter", "before"]).join(alone, ["part", "filter"])
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")
    return rows.select(
        "part", "filter_order", "step", "filter",
        (F.col("documents") - F.sum("removed").over(so_far)).alias("kept"),
        "removed", "redundant", "unique_fails",
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("removed").over(Window.partitionBy("part", "filter")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, conditions: Mapping[str, Column] | None = None, copies: str = "E", part: str = "lang") -> DataFrame:
    """:func:`interactions` of the filters over all documents."""
    parts, tables = failing_ids(docs, labels, conditions, copies, part)
    return interactions(parts, tables)
