"""Operators on the directed road graph: edges (src, dst, miles).

Searches that need a priority queue run in a kernel over distinct pairs, grouped by source so that they share a tree. The
graph is a dimension of some thousand edges; it is broadcast after a check of its size. Enumerations by depth are
joins, one a level, on edges that Spark broadcasts or shuffles as their size demands.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import stored

#: Edges beyond which a graph isn't broadcast.
MOST_EDGES = 2_000_000


class RoadGraph:
    """Adjacency of a directed graph. Of equal costs the path with fewer steps wins, then the one that sorts first."""

    def __init__(self, edges: Iterable[tuple], reverse_penalty: float | None = None):
        self.next: dict = {}
        self.previous: dict = {}
        rows = list(edges)
        if reverse_penalty is not None:
            rows += [(b, a, reverse_penalty) for a, b, _ in rows]
        for a, b, miles in rows:
            if miles < self.next.setdefault(a, {}).get(b, float("inf")):
                self.next[a][b] = miles
                self.previous.setdefault(b, {})[a] = miles

    def has_node(self, node) -> bool:
        return node in self.next or node in self.previous

    def has_edge(self, a, b) -> bool:
        return b in self.next.get(a, ())

    def tree(self, source, excluded: frozenset = frozenset(), targets: set | None = None) -> dict:
        """(cost, path) of the best path to each node that is reached, until all targets are."""
        done: dict = {}
        left = None if targets is None else set(targets)
        queue = [(0, 0, (source,))] if source not in excluded else []
        while queue and left != set():
            cost, hops, path = heapq.heappop(queue)
            node = path[-1]
            if node in done:
                continue
            done[node] = cost, path
            if left is not None:
                left.discard(node)
            for to, miles in self.next.get(node, {}).items():
                if to not in done and to not in excluded:
                    heapq.heappush(queue, (cost + miles, hops + 1, (*path, to)))
        return done

    def shortest(self, source, target, excluded: frozenset = frozenset()) -> tuple | None:
        return self.tree(source, excluded, {target}).get(target)

    def distances_to(self, target, excluded: frozenset = frozenset()) -> dict:
        done: dict = {}
        queue = [(0, target)] if target not in excluded else []
        while queue:
            cost, node = heapq.heappop(queue)
            if node in done:
                continue
            done[node] = cost
            for before, miles in self.previous.get(node, {}).items():
                if before not in done and before not in excluded:
                    heapq.heappush(queue, (cost + miles, before))
        return done

    def _leaving(self, way: tuple, cost, target, rest: dict, not_next: set, excluded: frozenset) -> tuple | None:
        """The best (cost, path) that starts with `way`, goes on to none of not_next and comes to the target without meeting a node twice."""
        done = set(way[:-1]) | excluded
        queue = [(cost + rest[way[-1]], len(way), way, cost)] if way[-1] in rest else []
        while queue:
            _, hops, path, so_far = heapq.heappop(queue)
            node = path[-1]
            if node == target:
                return so_far, path
            if node in done:
                continue
            done.add(node)
            for to, miles in self.next.get(node, {}).items():
                if to in rest and to not in done and not (len(path) == len(way) and to in not_next):
                    heapq.heappush(queue, (so_far + miles + rest[to], hops + 1, (*path, to), so_far + miles))
        return None

    def k_shortest(self, source, target, k: int, excluded: frozenset = frozenset()) -> list[tuple]:
        """The k best simple paths. Each one that is found is left at each of its nodes for the best way on that no found path takes; a search never
        opens a node twice, so the work is at most k times a path's length of them."""
        rest = self.distances_to(target, excluded)
        first = self._leaving((source,), 0, target, rest, set(), excluded) if source in rest else None
        out, queue, known = [], [] if first is None else [(first[0], len(first[1]), first[1])], {first[1]} if first else set()
        while queue and len(out) < k:
            cost, _, path = heapq.heappop(queue)
            out.append((cost, path))
            so_far = 0
            for i in range(len(path) - 1):
                way = path[: i + 1]
                taken = {p[i + 1] for _, p in out if p[: i + 1] == way}
                found = self._leaving(way, so_far, target, rest, taken, excluded)
                if found and found[1] not in known:
                    known.add(found[1])
                    heapq.heappush(queue, (found[0], len(found[1]), found[1]))
                so_far += self.next[path[i]][path[i + 1]]
        return out

    def disjoint(self, source, target, n: int) -> list[tuple]:
        """Up to n paths, each the best one that shares no inner node with those before."""
        out: list[tuple] = []
        banned: frozenset = frozenset()
        while len(out) < n:
            found = self.shortest(source, target, banned)
            if found is None:
                break
            out.append(found)
            inner = found[1][1:-1]
            if not inner:
                break
            banned |= frozenset(inner)
        return out


def shared_graph(edges: DataFrame, reverse_penalty: float | None = None):
    """A broadcast of the edges, whose number is checked; read it in a task with graph_of."""
    rows = edges.select("src", "dst", "miles").orderBy("src", "dst").limit(MOST_EDGES + 1).toPandas()
    if len(rows) > MOST_EDGES:
        raise ValueError(f"the graph has more than {MOST_EDGES} edges")
    return edges.sparkSession.sparkContext.broadcast((list(rows.itertuples(index=False, name=None)), reverse_penalty))


def graph_of(shared) -> RoadGraph:
    return RoadGraph(*shared.value)


def _by_source(pairs: DataFrame, edges: DataFrame, solve, reverse_penalty: float | None) -> DataFrame:
    """pairs: source, target. solve(graph, source, targets) gives rows source, target, path_no, miles, path."""
    shared = shared_graph(edges, reverse_penalty)
    node = dict(edges.dtypes)["src"]
    schema = f"source {node}, target {node}, path_no int, miles double, path array<{node}>"

    def run(group: pd.DataFrame) -> pd.DataFrame:
        source = group["source"].iloc[0].item() if hasattr(group["source"].iloc[0], "item") else group["source"].iloc[0]
        rows = solve(graph_of(shared), source, group["target"].tolist())
        return pd.DataFrame(rows, columns=["source", "target", "path_no", "miles", "path"])

    keys = pairs.select(F.col("source").cast(node), F.col("target").cast(node)).where("source is not null and target is not null").distinct()
    return keys.groupBy("source").applyInPandas(run, schema)


def shortest_paths(pairs: DataFrame, edges: DataFrame, excluded: Sequence = (), reverse_penalty: float | None = None) -> DataFrame:
    """Best path of each distinct pair that has one. reverse_penalty: cost at which any edge may be driven backwards."""
    banned = frozenset(excluded)

    def solve(graph, source, targets):
        tree = graph.tree(source, banned, set(targets))
        return [(source, t, 1, float(tree[t][0]), list(tree[t][1])) for t in targets if t in tree]

    return _by_source(pairs, edges, solve, reverse_penalty)


def k_shortest_paths(pairs: DataFrame, edges: DataFrame, k: int, excluded: Sequence = (), reverse_penalty: float | None = None) -> DataFrame:
    banned = frozenset(excluded)
    return _by_source(pairs, edges, lambda graph, s, targets: [(s, t, i + 1, float(c), list(p)) for t in targets for i, (c, p) in enumerate(graph.k_shortest(s, t, k, banned))], reverse_penalty)


def disjoint_paths(pairs: DataFrame, edges: DataFrame, n: int, reverse_penalty: float | None = None) -> DataFrame:
    return _by_source(pairs, edges, lambda graph, s, targets: [(s, t, i + 1, float(c), list(p)) for t in targets for i, (c, p) in enumerate(graph.disjoint(s, t, n))], reverse_penalty)


def simple_paths(edges: DataFrame, sources: DataFrame, max_depth: int) -> DataFrame:
    """All simple paths of up to max_depth steps from the sources (column source): source, target, miles, path. Each level is stored once."""
    step = edges.select(F.col("src").alias("_src"), F.col("dst").alias("_dst"), F.col("miles").alias("_miles"))
    front = sources.select("source", F.col("source").alias("target"), F.lit(0).cast("bigint").alias("miles"), F.array("source").alias("path"))
    found = None
    for _ in range(max_depth):
        front = front.join(step, front["target"] == step["_src"]).where(~F.array_contains("path", F.col("_dst")))
        front = stored(front.select("source", F.col("_dst").alias("target"), (F.col("miles") + F.col("_miles")).alias("miles"), F.array_append("path", F.col("_dst")).alias("path")), "simple-paths")
        found = front if found is None else found.unionByName(front)
    return found


def bounded_paths(paths: DataFrame, factor: float = 2.0, most: int | None = None) -> DataFrame:
    """Paths of at most `factor` times their pair's shortest, best first."""
    from pyspark.sql.window import Window

    by = Window.partitionBy("source", "target")
    found = paths.withColumn("_least", F.min("miles").over(by)).where(F.col("miles") <= factor * F.col("_least")).drop("_least")
    found = found.withColumn("path_no", F.row_number().over(by.orderBy("miles", F.size("path"), "path")))
    return found.where(F.col("path_no") <= most) if most else found


def remaining_miles(targets: DataFrame, edges: DataFrame, max_depth: int) -> DataFrame:
    """(target, node, rest): the fewest miles from a node to a target in at most 0, 1, .. max_depth steps; null where none lead there. targets: target."""
    shared = shared_graph(edges)
    node = dict(edges.dtypes)["src"]

    def run(batches):
        previous = graph_of(shared).previous
        for batch in batches:
            for target in batch["target"].tolist():
                best, rows, front = {target: 0}, {target: [0.0]}, {target}
                for steps in range(1, max_depth + 1):
                    nearer = {}
                    for b in front:
                        for a, miles in previous.get(b, {}).items():
                            nearer[a] = min(nearer.get(a, best.get(a, float("inf"))), best[b] + miles)
                    front = {a for a, m in nearer.items() if m < best.get(a, float("inf"))}
                    best |= {a: nearer[a] for a in front}
                    for a in best:
                        mine = rows.setdefault(a, [])
                        mine += [None] * (steps - len(mine)) + [float(best[a])]
                yield pd.DataFrame({"target": [target] * len(rows), "node": list(rows), "rest": list(rows.values())})

    return targets.select(F.col("target").cast(node)).where("target is not null").distinct().mapInPandas(run, f"target {node}, node {node}, rest array<double>")


def bounded_levels(pairs: DataFrame, edges: DataFrame, factor: float = 2.0, max_depth: int = 30) -> Iterator[DataFrame]:
    """After each step the partial paths that can still reach their target within the bound: source, target, node, miles, path, bound.

    The bound is factor times the pair's shortest miles in at most max_depth steps. A partial path goes as soon as its miles and the
    fewest that are left, in the steps that are left, exceed it. Each level is stored, so the next one doesn't plan it again.
    """
    node = dict(edges.dtypes)["src"]
    wanted = pairs.select(F.col("source").cast(node), F.col("target").cast(node)).where("source <> target").distinct()
    rest = stored(remaining_miles(wanted.select("target"), edges, max_depth), "bounded-rest")
    step = edges.where("src <> dst").groupBy(F.col("src").alias("_src"), F.col("dst").alias("_dst")).agg(F.min("miles").alias("_miles"))
    ends = rest.select("target", F.col("node").alias("source"), (F.element_at("rest", -1) * factor).alias("bound"))
    front = wanted.join(ends, ["source", "target"]).select("source", "target", F.col("source").alias("node"), F.lit(0).cast(dict(edges.dtypes)["miles"]).alias("miles"), F.array("source").alias("path"), "bound")
    for depth in range(1, max_depth + 1):
        grown = front.where("node <> target").join(step, front["node"] == step["_src"]).where(~F.array_contains("path", F.col("_dst")))
        grown = grown.select("source", "target", F.col("_dst").alias("node"), (F.col("miles") + F.col("_miles")).alias("miles"), F.array_append("path", F.col("_dst")).alias("path"), "bound")
        left = rest.select("target", "node", F.get("rest", F.lit(max_depth - depth)).alias("_rest"))
        front = stored(grown.join(left, ["target", "node"]).where(F.col("miles") + F.col("_rest") <= F.col("bound")).select("source", "target", "node", "miles", "path", "bound"), "bounded-level")
        if front.isEmpty():
            return
        yield front


def bounded_search(pairs: DataFrame, edges: DataFrame, factor: float = 2.0, max_depth: int = 30, most: int | None = 100) -> DataFrame:
    """Simple paths of at most max_depth steps and factor times their pair's shortest miles, the `most` best of each pair: source, target, path_no, miles, path.

    Best is fewest miles, then fewest units, then the path that sorts first. A pair of one unit has no path, nor has one that no path joins.
    Runs a job a level when called.
    """
    from pyspark.sql.window import Window

    found = None
    for level in bounded_levels(pairs, edges, factor, max_depth):
        there = level.where("node = target").select("source", "target", "miles", "path")
        found = there if found is None else found.unionByName(there)
    if found is None:
        found = pairs.join(edges, F.lit(False)).select("source", "target", "miles", F.array("src").alias("path"))
    rank = F.row_number().over(Window.partitionBy("source", "target").orderBy("miles", F.size("path"), "path"))
    found = found.withColumn("path_no", rank)
    return (found if most is None else found.where(F.col("path_no") <= most)).select("source", "target", "path_no", "miles", "path")


def levels_from(step: dict, source, max_level: int, blocked=frozenset()) -> dict:
    """Steps from source to each node within max_level; blocked nodes aren't entered. step: node to its next nodes."""
    seen, front = {source: 0}, [source]
    for level in range(1, max_level + 1):
        front = [b for b in dict.fromkeys(b for a in front for b in step.get(a, ())) if b not in seen and b not in blocked]
        if not front:
            break
        seen |= dict.fromkeys(front, level)
    return seen


def reach_levels(edges: DataFrame, sources: DataFrame, max_level: int, allowed: DataFrame | None = None, blocked: DataFrame | None = None, backwards: bool = False) -> DataFrame:
    """(source, node, level): steps from each source to each node within max_level, over allowed and not blocked nodes (column node).

    Breadth-first in a kernel over distinct sources: the graph that is left after both filters is broadcast, its size
    checked. Level by level as joins, each level's rows would be planned twice by the next.
    """
    to = "src" if backwards else "dst"
    if allowed is not None:
        edges = edges.join(allowed.select(F.col("node").alias(to)).distinct(), to, "left_semi")
    if blocked is not None:
        edges = edges.join(blocked.select(F.col("node").alias(to)).distinct(), to, "left_anti")
    shared = shared_graph(edges)
    node = dict(edges.dtypes)["src"]

    def run(batches):
        graph = graph_of(shared)
        step = graph.previous if backwards else graph.next
        for batch in batches:
            rows = [(s, n, level) for s in batch["source"].tolist() for n, level in levels_from(step, s, max_level).items()]
            yield pd.DataFrame(rows, columns=["source", "node", "level"])

    return sources.select(F.col("source").cast(node)).distinct().mapInPandas(run, f"source {node}, node {node}, level int")


def works_components(works: DataFrame, edges: DataFrame) -> DataFrame:
    """(works_id, unit, component): weakly connected parts of each works' units, named by their smallest unit. works: works_id, unit.

    The edges inside a works are joined first; what one group holds is a single construction site.
    """
    pair = works.alias("a").join(edges, F.col("a.unit") == edges["src"]).join(works.alias("b"), (F.col("b.works_id") == F.col("a.works_id")) & (F.col("b.unit") == edges["dst"]))
    inner = pair.select(F.col("a.works_id").alias("works_id"), F.col("a.unit").alias("u"), F.col("b.unit").alias("v"))
    alone = works.select("works_id", F.col("unit").alias("u"), F.col("unit").alias("v"))
    kind = dict(works.dtypes)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        parent = {x: x for x in group["u"]}

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for u, v in zip(group["u"], group["v"], strict=True):
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
        units = sorted(parent)
        return pd.DataFrame({"works_id": group["works_id"].iloc[0], "unit": units, "component": [root(x) for x in units]})

    return inner.unionByName(alone).groupBy("works_id").applyInPandas(run, f"works_id {kind['works_id']}, unit {kind['unit']}, component {kind['unit']}")


def portals(parts: DataFrame, edges: DataFrame) -> DataFrame:
    """(works_id, component, unit, kind): units with a neighbour outside their part; entry if it leads in, exit if it leads out."""
    inside = parts.select(F.col("works_id").alias("_w"), F.col("component").alias("_c"), F.col("unit").alias("_u"))

    def of(here: str, there: str, kind: str) -> DataFrame:
        near = parts.join(edges, parts["unit"] == edges[here]).select("works_id", "component", "unit", F.col(there).alias("other"))
        out = near.join(inside, (F.col("works_id") == F.col("_w")) & (F.col("component") == F.col("_c")) & (F.col("other") == F.col("_u")), "left_anti")
        return out.select("works_id", "component", "unit").distinct().withColumn("kind", F.lit(kind))

    return of("dst", "src", "entry").unionByName(of("src", "dst", "exit"))


def built_edges(relations: DataFrame, version: str, penalty: float | None = None) -> DataFrame:
    """src, dst, miles and reverse_miles of a version's graph. relations: src, dst, miles, version.

    Missing or zero miles count as 1, so that every edge costs something; relations without an end go; of parallel ones the shortest stays. Driving
    backwards costs the penalty (1e9 if none is given), which only a search that asks for it uses.
    """
    of = relations.where((F.col("version") == version) & F.col("src").isNotNull() & F.col("dst").isNotNull())
    cost = F.coalesce(F.nullif("miles", F.lit(0)), F.lit(1))
    return of.groupBy("src", "dst").agg(F.min(cost).alias("miles")).withColumn("reverse_miles", F.lit(1e9 if penalty is None else float(penalty)))


def neighbours(edges: DataFrame, unit, backwards: bool = False) -> DataFrame:
    here, there = ("dst", "src") if backwards else ("src", "dst")
    return edges.where(F.col(here) == unit).select(F.col(there).alias("unit"), "miles")


def drilled(edges: DataFrame) -> DataFrame:
    """(origin, unit, level): neighbours of each unit (1) and theirs (2), each at its least level."""
    first = edges.select(F.col("src").alias("origin"), F.col("dst").alias("unit"), F.lit(1).alias("level"))
    second = first.join(edges.select(F.col("src").alias("unit"), "dst"), "unit").select("origin", F.col("dst").alias("unit"), F.lit(2).alias("level"))
    return first.unionByName(second).groupBy("origin", "unit").agg(F.min("level").alias("level"))


def near_works(pairs: DataFrame, works: DataFrame, edges: DataFrame, column: str, most_nodes: int) -> DataFrame:
    """Values of pairs' column whose best path to or from a unit under works has at most most_nodes nodes. works: unit."""
    ends = pairs.select(F.col(column).alias("unit")).distinct()
    out = None
    for backwards in (False, True):
        levels = reach_levels(edges, works.select(F.col("unit").alias("source")), most_nodes - 1, backwards=backwards)
        out = levels if out is None else out.unionByName(levels)
    return ends.join(out.select(F.col("node").alias("unit")).distinct(), "unit", "left_semi")


def fewest_steps(pairs: DataFrame, edges: DataFrame, excluded: Sequence = ()) -> DataFrame:
    """A path of the fewest steps for each distinct pair that has one; miles are its steps."""
    return shortest_paths(pairs, edges.withColumn("miles", F.lit(1)), excluded)
