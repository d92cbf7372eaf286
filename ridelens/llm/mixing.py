"""Mixing overlapping sources to target sizes by minimum-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong
to). A pattern offers its words once at cost 0, again at cost 1, and so on up to
``max_repeats`` times; sources draw from the patterns that contain them, up to
their quotas. Costs lie on the patterns' arcs alone and a shortest augmenting
path uses exactly one of those, so augmenting to the maximum with one offer,
then with two, then with three, is successive shortest paths: each result is a
flow of least cost for its value. What a pattern gives is then its number of
whole passes over its documents, and a rest that is filled with documents in a
seeded order, the last one in part.

Patterns and sources go through the driver: they are configuration-sized, and
more than ``MAX_PATTERNS`` of them is an error, not a cut. Documents do not.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelens.llm.runtime import documents, fresh, settle, table

MAX_PATTERNS = 100_000
MAX_REPEATS = 3
SEED = 20
WEIGHTS = (5, 2, 1)
#: Documents are taken in the order of a hash of so many bits; the place where a
#: pattern's rest is reached is found so many bits at a time.
ORDER_BITS, CELL_BITS = 62, 12

Source = str | None


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def weighted_targets(sizes: dict[Source, int], weights: tuple[int, ...] = WEIGHTS, most: int = MAX_REPEATS) -> dict[Source, float]:
    """Sources in code point order (null last) weigh ``weights``, repeating, and
    share all words. A target stops at ``most`` times its source's size; the
    excess is shared again by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weigh = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_weight = sum(weigh[s] for s in order if s not in full)
        targets = {s: float(most * sizes[s]) if s in full else left * weigh[s] / open_weight for s in order}
        above = {s for s in order if s not in full and targets[s] > most * sizes[s]}
        if not above:
            return targets
        full |= above


class _Routes:
    """The flow network with its patterns seen through the sources, which are
    few: words move from source to source wherever a pattern that feeds the one
    also contains the other."""

    def __init__(self, patterns: list[tuple[tuple[Source, ...], int]], quotas: dict[Source, int]):
        at = {s: i for i, s in enumerate(quotas)}
        self.members = [sorted({at[s] for s in own if s in at}) for own, _ in patterns]
        self.open = list(quotas.values())
        self.drawn: list[dict[int, int]] = [{} for _ in patterns]
        self.given = [0] * len(patterns)
        self.spare = [0] * len(patterns)
        n = len(self.open)
        # Patterns that feed a source and contain another; entries may be out of date.
        self._moves: list[list[list[int]]] = [[[] for _ in range(n)] for _ in range(n)]
        self._ready: list[list[int]] = [[] for _ in range(n)]  # patterns with words to spare, by source

    def _draw(self, p: int, s: int, amount: int) -> None:
        drawn = self.drawn[p]
        if s not in drawn:
            drawn[s] = 0
            for other in self.members[p]:
                if other != s:
                    self._moves[s][other].append(p)
        drawn[s] += amount

    def _undraw(self, p: int, s: int, amount: int) -> None:
        self.drawn[p][s] -= amount
        if not self.drawn[p][s]:
            del self.drawn[p][s]

    def _top(self, stack: list[int], holds: Callable[[int], bool]) -> int | None:
        """The last entry that still holds; those that do not are dropped."""
        while stack and not holds(stack[-1]):
            stack.pop()
        return stack[-1] if stack else None

    def offer(self, words: list[int]) -> None:
        """Raises every pattern's spare words by ``words`` and routes what can be."""
        for p, more in enumerate(words):
            self.spare[p] += more
            for s in self.members[p]:  # straight to sources below their quota
                amount = min(self.spare[p], self.open[s])
                if amount > 0:
                    self._draw(p, s, amount)
                    self.spare[p] -= amount
                    self.given[p] += amount
                    self.open[s] -= amount
        self._ready = [[] for _ in self.open]
        for p, left in enumerate(self.spare):
            if left > 0:
                for s in self.members[p]:
                    self._ready[s].append(p)
        while self._augment():
            pass

    def _augment(self) -> bool:
        """Moves words along one shortest path from a pattern with words to spare
        to a source below its quota."""
        came: dict[int, tuple[int, int]] = {}  # source: (the source it is reached from, by which pattern)
        level = []
        for s in range(len(self.open)):
            p = self._top(self._ready[s], lambda p: self.spare[p] > 0)
            if p is not None:
                came[s] = (-1, p)
                level.append(s)
        end = next((s for s in level if self.open[s] > 0), None)
        while level and end is None:
            after = []
            for s in level:
                for other in range(len(self.open)):
                    if other not in came:
                        p = self._top(self._moves[s][other], lambda p, s=s: self.drawn[p].get(s, 0) > 0)
                        if p is not None:
                            came[other] = (s, p)
                            after.append(other)
            level = after
            end = next((s for s in level if self.open[s] > 0), None)
        if end is None:
            return False
        path = [end]
        while came[path[-1]][0] >= 0:
            path.append(came[path[-1]][0])
        first = came[path[-1]][1]
        amount = min([self.spare[first], self.open[end], *[self.drawn[came[s][1]][came[s][0]] for s in path[:-1]]])
        for s in path:
            source, p = came[s]
            if source >= 0:
                self._undraw(p, source, amount)
            self._draw(p, s, amount)
        self.spare[first] -= amount
        self.given[first] += amount
        self.open[end] -= amount
        return True


def route(patterns: list[tuple[tuple[Source, ...], int]], quotas: dict[Source, int], max_repeats: int = MAX_REPEATS) -> list[int]:
    """Words each pattern (its sources, its words) gives, at least cost, so that
    sources get as much of their quotas as the patterns can give."""
    network = _Routes(patterns, quotas)
    for _ in range(max_repeats):
        network.offer([size for _, size in patterns])
    return network.given


def _cuts(slim: DataFrame, wanted: DataFrame) -> DataFrame:
    """(pattern, cut, before): the order at which the words of a pattern, summed
    in order, reach its ``rest``, and their sum before it. Sums over cells of
    the order, then over cells of the cell that holds the cut, and so on: no
    documents are put in order, and a step's sums are ``1 << CELL_BITS`` a
    pattern at most."""
    edges = wanted.select("pattern", "rest", F.lit(0).cast("bigint").alias("cell"), F.lit(0).cast("bigint").alias("before"))
    bits = ORDER_BITS
    while True:
        above, bits = bits, max(0, bits - CELL_BITS)
        mine = slim.join(F.broadcast(edges), "pattern").where(F.shiftright("order", above) == F.col("cell") if above < ORDER_BITS else F.lit(True))
        sums = mine.groupBy("pattern", "rest", "before", F.shiftright("order", bits).alias("cell")).agg(F.sum("words").alias("words"), F.min("order").alias("low"), F.max("order").alias("high"))
        upto = Window.partitionBy("pattern").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.col("before") + F.coalesce(F.sum("words").over(upto), F.lit(0)))
        edges = settle(sums.where("before < rest and before + words >= rest").select("pattern", "rest", "cell", "before", "low", "high"), "mix-edges")
        if not bits or edges.where("low < high").isEmpty():
            return edges.select("pattern", F.col("low").alias("cut"), "before")
        edges = edges.drop("low", "high")


def mix(df: DataFrame, size: Column, members: Column, quotas: Callable[[dict[Source, int]], dict[Source, float]] = weighted_targets, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> tuple[DataFrame, dict[Source, float], dict[Source, int]]:
    """Takes documents so that each source's words come to its target.

    ``df`` has doc_id; ``size`` is a row's words and ``members`` the array of
    its sources (a null element is a source of its own). ``quotas`` gives the
    targets for the sources' sizes. Returns (rows, targets, sizes): the rows of
    ``df`` with mix_size and mix_taken (words taken, repeats counted), or those
    names lengthened if ``df`` has them.

    Defined cases: rows without sources or words give nothing; rows that repeat
    a doc_id are taken one by one; a null doc_id comes first among equal hashes;
    targets beyond ``max_repeats`` times what is there are met as far as
    that; a very long text is one document, taken in part at most once; an empty
    table gives an empty result. Reruns agree. ``df`` is read
    twice and must give the same rows both times (a table, or a settled frame)."""
    spark = df.sparkSession
    names = {n: fresh(df.columns, n) for n in ("mix_size", "mix_taken", "mix_pattern", "mix_order", "mix_before", "mix_full", "mix_rest", "mix_cut", "mix_base")}
    key = F.to_json(F.struct(F.array_sort(F.array_distinct(members)).alias("m")), {"ignoreNullFields": "false"})
    order = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id"), F.lit(-1))).bitwiseAND(F.lit((1 << ORDER_BITS) - 1))
    rows = df.select("*", size.cast("bigint").alias(names["mix_size"]), key.alias(names["mix_pattern"]), order.alias(names["mix_order"]))
    # What decides is three numbers a document; texts are read again at the end alone.
    slim = settle(rows.select(F.col(names["mix_pattern"]).alias("pattern"), F.col(names["mix_order"]).alias("order"), F.col(names["mix_size"]).alias("words")), "mix-sizes")
    sums = slim.groupBy("pattern").agg(F.sum("words").alias("words"))

    found = sums.limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns: group rare sources first")
    patterns = sorted(((r.pattern, tuple(json.loads(r.pattern).get("m") or ()), r.words) for r in found), key=lambda x: x[0])
    sizes: dict[Source, int] = {}
    for _, own, words in patterns:
        for s in own:
            sizes[s] = sizes.get(s, 0) + words
    targets = quotas(sizes) if sizes else {}
    given = route([(own, words) for _, own, words in patterns], {s: round(t) for s, t in targets.items()}, max_repeats)
    plan = [(p, g // w if w else 0, g % w if w else 0) for (p, _, w), g in zip(patterns, given, strict=True)]

    planned = spark.createDataFrame(plan, "pattern string, full bigint, rest bigint")
    cuts = _cuts(slim, planned.where("rest > 0").select("pattern", "rest"))
    plan_rows = planned.join(cuts, "pattern", "left").select(
        F.col("pattern").alias(names["mix_pattern"]), F.col("full").alias(names["mix_full"]), F.col("rest").alias(names["mix_rest"]), F.col("cut").alias(names["mix_cut"]), F.col("before").alias(names["mix_base"])
    )
    rows = rows.join(F.broadcast(plan_rows), names["mix_pattern"])

    # Only documents that share the cut's hash (those of one doc_id) are put in order.
    c = {k: F.col(v) for k, v in names.items() if k not in ("mix_taken", "mix_before")}
    is_edge = F.coalesce(c["mix_order"] == c["mix_cut"], F.lit(False))
    last = rows.where(is_edge)
    seq = Window.partitionBy(names["mix_pattern"]).orderBy("doc_id", names["mix_size"]).rowsBetween(Window.unboundedPreceding, -1)
    last = last.withColumn(names["mix_before"], c["mix_base"] + F.coalesce(F.sum(names["mix_size"]).over(seq), F.lit(0)))
    last = last.withColumn(names["mix_taken"], c["mix_full"] * c["mix_size"] + F.greatest(F.lit(0), F.least(c["mix_size"], c["mix_rest"] - F.col(names["mix_before"]))))
    rest = rows.where(~is_edge).withColumn(names["mix_taken"], c["mix_full"] * c["mix_size"] + F.when(c["mix_order"] < c["mix_cut"], c["mix_size"]).otherwise(0))
    out = [*[F.col(f"`{x}`") for x in df.columns], F.col(names["mix_size"]), F.col(names["mix_taken"]).cast("bigint").alias(names["mix_taken"])]
    return rest.select(out).unionByName(last.select(out)), targets, sizes


def take_mix(df: DataFrame) -> DataFrame:
    """The rows of ``df`` (doc_id, text, source and others) that the mix takes
    words from, with their size and the words taken. Cases as in ``mix``; a null
    text has no words and goes, a null source is a source."""
    rows, _, _ = mix(df, word_count(), F.array(F.col("source").cast("string")))
    size, taken = rows.columns[-2:]
    return rows.where(F.col(taken) > 0).withColumnsRenamed({size: fresh(df.columns, "size"), taken: fresh(df.columns, "taken")})


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents by source; cases as in ``mix``."""
    docs = documents(table(spark, sf_dir, "documents"), "doc_id", "text", "source")
    docs = settle(docs.select("doc_id", "source", word_count().alias("size")), "sizes")
    rows, targets, sizes = mix(docs, F.col("size"), F.array("source"))
    facts = spark.createDataFrame([(s, sizes[s], float(t)) for s, t in targets.items()], "name string, source_size bigint, target double")
    rows = rows.join(F.broadcast(facts), F.col("source").eqNullSafe(F.col("name")), "left")
    return rows.select("doc_id", "size", "source_size", "target", F.col("mix_taken").alias("taken"), "source")
