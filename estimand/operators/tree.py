"""Honest causal tree grown level by level.

Features are categories or quantile bins, so rows with equal features and arm
are first collapsed to (n, sum, sum of squares) whenever that shrinks the table
a lot; all levels then work on the collapsed rows.  Per level one aggregation
counts every (node, feature, value) cell of all open nodes together, windows
over the cells (range partitions, where a feature has very many values) find the
splits, and one row per node and feature reaches the driver.  Node membership is
a CASE expression over the features, so no row is rewritten between levels;
splits of very many values stay tables that the rows are joined with.
"""

import math
from dataclasses import dataclass, field

from pyspark.sql import Window as W, functions as F

from estimand.functions import dist
from estimand.functions.columns import TREE_QUANTILES, as_column, bin_labels, cut_bins, split_random
from estimand.operators.fdr import q_values
from estimand.operators.ranktests import discrete_quantiles
from estimand.plans.moments import Moments, merge_all
from estimand.plans.prefix import stored
from estimand.plans.segments import segmented_prefix, with_totals

NUMERIC = ("byte", "short", "integer", "long", "float", "double", "decimal")
# Smallest left arm of a split, normal quantile of node intervals.
MIN_ARM = 100
Z_INTERVAL = 1.96
COLLAPSE_FACTOR = 20  # collapse when it leaves at most 1/20 of the rows
#: Values of a (node, feature) that one window task walks; more are walked over range partitions.
WALKED_VALUES = 200_000
#: Values of a split that become a list on the driver; more stay a table that rows are joined with.
LISTED_VALUES = 1_000
SUMS = ("y1", "y1_sq", "n1", "y0", "y0_sq", "n0")


def check_columns(df, Y, T, X, needcut_X=()):
    """Required arguments, columns and types; raises ValueError."""
    for name, value in (("Y", Y), ("T", T), ("X", X)):
        if not value:
            raise ValueError(f"missing {name}")
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    for c in [Y, T, *X, *needcut_X]:
        if c not in types:
            raise ValueError(f"column {c} does not exist")
    for role, cols in (("Y", [Y]), ("T", [T]), ("needcut_X", needcut_X)):
        for c in cols:
            if types[c] not in NUMERIC:
                raise ValueError(f"{role} column {c} must be numeric")


def check_arms(n1, n0, other):
    if not n1 + n0 + other:
        raise ValueError("the input is empty")
    if other or not n1 or not n0:
        raise ValueError("the treatment must take the values 0 and 1")


def validate_inputs(df, Y, T, X, needcut_X=()):
    """``check_columns`` plus a look at the data: non-empty, T in {0, 1}."""
    check_columns(df, Y, T, X, needcut_X)
    t = F.col(T)
    got = df.agg(F.count_if(t == 1).alias("n1"), F.count_if(t == 0).alias("n0"),
                 F.count_if(~t.isin(0, 1)).alias("other")).first()
    check_arms(got["n1"], got["n0"], got["other"])


def unit_rows(df, names):
    """Rows as one-row groups: features, _t, n, s = y, q = y^2."""
    return df.select(*names, "_t", F.expr("1L AS _n"), F.expr("_y AS _s"), F.expr("_y * _y AS _q"))


def cell_sums(groups, node, features):
    """Arm sums per (node, feature, value); nulls of a feature form no cell.

    ``groups`` holds _t, _n, _s, _q per (group of) rows.  The pseudo feature ''
    carries the node totals.
    """
    cells = F.array(
        F.struct(F.lit("").alias("feature"), F.lit("").alias("value")),
        *[F.struct(F.lit(name).alias("feature"), col.cast("string").alias("value")) for name, col in features.items()],
    )
    long = groups.select(node.alias("node"), "_t", "_n", "_s", "_q", F.inline(cells)).where(
        "node is not null and value is not null")
    return long.groupBy("node", "feature", "value").agg(*[
        F.expr(f"sum(if(_t = {i}, {c}, {zero}))").alias(name)
        for i in (1, 0)
        for c, zero, name in (("_s", "0D", f"y{i}"), ("_q", "0D", f"y{i}_sq"), ("_n", "0L", f"n{i}"))
    ])


def effect_sql(p=""):
    """E = tau^2 n / 2 - n (v1 / n1 + v0 / n0) with plug-in variances, over
    columns with prefix ``p``."""
    m1, m0 = f"{p}y1 / {p}n1", f"{p}y0 / {p}n0"
    v1, v0 = f"({p}y1_sq / {p}n1 - ({m1}) * ({m1}))", f"({p}y0_sq / {p}n0 - ({m0}) * ({m0}))"
    n = f"({p}n1 + {p}n0)"
    return f"(0.5D * power({m1} - {m0}, 2) * {n} - {n} * ({v1} / {p}n1 + {v0} / {p}n0))"


def node_totals(cells):
    """{node: row of arm sums and E} of all nodes in a cell table."""
    both = "if(n1 > 0 and n0 > 0, " + effect_sql() + ", null) AS effect"
    return {r["node"]: r for r in cells.where("feature = ''").selectExpr("node", *SUMS, both).collect()}


def _walked(usable):
    """Sums of all values up to each one (l_) and of all (a_), by effect: one window for each (node, feature)."""
    part = "PARTITION BY node, feature"
    upto = f"({part} ORDER BY tau DESC, value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return usable.selectExpr(
        "node", "feature", "value", "tau", f"row_number() OVER ({part} ORDER BY tau DESC, value) AS rank",
        f"count(1) OVER ({part}) AS values",
        *[f"sum({c}) OVER {upto} AS l_{c}" for c in SUMS], *[f"sum({c}) OVER ({part}) AS a_{c}" for c in SUMS])


def _walked_apart(usable):
    """As ``_walked``, over range partitions of (node, feature, effect): a feature of any number of values is many tasks."""
    rows = usable.withColumns({"_down": -F.col("tau"), "_one": F.lit(1)})
    placed = segmented_prefix(rows, ["node", "feature"], ["_down", "value"], ["_one", *SUMS], keep=["tau"])
    placed = with_totals(placed, ["node", "feature"], values=F.sum("_one"), **{f"a_{c}": F.sum(c) for c in SUMS})
    return placed.select(
        "node", "feature", "value", "tau", (F.col("_one_before") + 1).cast("int").alias("rank"), "values",
        *[(F.col(f"{c}_before") + F.col(c)).alias(f"l_{c}") for c in SUMS], *[f"a_{c}" for c in SUMS])


def split_candidates(cells, parents, total, min_ratio, min_arm=MIN_ARM):
    """Prefixes of the values ordered by effect, with their gain.

    ``cells`` is a ``cell_sums`` table, ``parents`` maps each node to be split to
    (rows, E of the node), ``total`` is the number of training rows.  Returns
    node, feature, value, rank, tau, the left / right effects and gain (NULL
    where a size rule fails).
    """
    table = "map(" + ", ".join(
        f"{node}, named_struct('n', {n}L, 'e', double('{float(e)!r}'))" for node, (n, e) in parents.items()) + ")"
    usable = cells.where("feature <> '' and n1 > 0 and n0 > 0").where(F.col("node").isin(list(parents))).selectExpr(
        "*", "y1 / n1 - y0 / n0 AS tau")
    most = usable.groupBy("node", "feature").count().agg(F.max("count")).first()[0] or 0
    walked = (_walked if most <= WALKED_VALUES else _walked_apart)(usable).selectExpr("*", f"{table}[node] AS parent")
    floor = float(min_ratio * total)
    allowed = (
        f"rank < values and l_n0 > {min_arm} and l_n1 > {min_arm} and l_n1 + l_n0 > {floor}D "
        f"and parent.n - l_n1 - l_n0 > {floor}D"
    )
    split = walked.selectExpr("node", "feature", "value", "rank", "tau", "parent", f"{allowed} AS allowed",
                              *[f"l_{c}" for c in SUMS], *[f"a_{c} - l_{c} AS r_{c}" for c in SUMS])
    scored = split.selectExpr(
        "node", "feature", "value", "rank", "tau", "parent",
        f"if(allowed, {effect_sql('l_')}, null) AS left_effect",
        f"if(allowed, {effect_sql('r_')}, null) AS right_effect")
    return scored.selectExpr("node", "feature", "value", "rank", "tau", "left_effect", "right_effect",
                             "left_effect + right_effect - parent.e AS gain")


def tree_split_search(df, Y, T, features, min_ratio=0.001, total=None):
    """All root-level split candidates of ``df`` (features: name -> column)."""
    work = df.select(as_column(Y).cast("double").alias("_y"), as_column(T).cast("int").alias("_t"),
                     *[as_column(e).alias(n) for n, e in features.items()])
    cells = cell_sums(unit_rows(work, list(features)), F.lit(1), {n: F.col(n) for n in features})
    root = node_totals(cells)[1]
    n = root["n1"] + root["n0"]
    return split_candidates(cells, {1: (n, root["effect"])}, n if total is None else total, min_ratio)


@dataclass
class Node:
    node_id: int
    level: int
    path: tuple  # ((feature, "in" / "not in", values), ...)
    impurity: float = None
    feature: str = None
    left_values: list = field(default_factory=list)
    right_values: list = field(default_factory=list)
    gain: float = None
    sides: object = None  # table (node, value, left) of a split of many values; then there are no lists
    size: int = 0  # its values on the left

    @property
    def is_leaf(self):
        return self.feature is None


NODE_SCHEMA = (
    "node_id int, parent int, level int, is_leaf boolean, split_feature string, split_values array<string>, "
    "rule string, gain double, impurity double, ratio double, prediction double, treated_count bigint, "
    "control_count bigint, treated_avg double, control_avg double, treated_std double, control_std double, "
    + ", ".join(
        f"est_point{i} double, std{i} double, pvalue{i} double, zvalue{i} double, lower{i} double, upper{i} double, "
        f"qvalue{i} double"
        for i in range(1, 5)
    )
)


def node_inference(m1, m0, ate, is_root):
    """The four effect scales of one node from its arm moments."""
    y1, y0 = float(m1.mean[0]), float(m0.mean[0])
    v1, v0 = float(m1.cov()[0, 0]), float(m0.cov()[0, 0])
    out = {
        "prediction": y1 - y0, "treated_count": m1.n, "control_count": m0.n, "treated_avg": y1, "control_avg": y0,
        "treated_std": math.sqrt(v1), "control_std": math.sqrt(v0),
    }
    std = math.sqrt(v1 / m1.n + v0 / m0.n)

    def scale(i, est, z, half):
        p = 2 * dist.norm_sf(abs(z)) if not math.isnan(z) else math.nan
        out.update({f"est_point{i}": est, f"std{i}": std, f"pvalue{i}": p, f"zvalue{i}": z,
                    f"lower{i}": est - half, f"upper{i}": est + half})

    def ratio(a, b):
        return a / b if b else math.nan

    e1, e2 = y1 - y0, y1 - y0 - ate
    # without a control mean the relative scales have no value
    e3, e4 = ratio(y1, y0) - 1, ratio(y1 - ate, y0) - 1
    z1, z2 = ratio(e1, std), ratio(e2, std)
    scale(1, e1, z1, Z_INTERVAL * std)
    scale(2, e2, z2, Z_INTERVAL * std)
    scale(3, e3, z1, Z_INTERVAL * std * ratio(e3, e1))
    if is_root:
        # the root is its own baseline
        out["est_point2"] = 0.0
        scale(4, 0.0, z2, 0.0)
    else:
        scale(4, e4, z2, Z_INTERVAL * std * ratio(e4, e2))
    return out


class CausalTree:
    """``fit`` on half of the rows, estimate effects on the other half.

    ``key`` columns identify rows for the seeded 50/50 split; ``split`` replaces
    it by an own 0 (grow) / 1 (estimate) expression.
    """

    def __init__(self, depth=3, min_sample_ratio_leaf=0.001, min_arm=MIN_ARM, seed=0):
        self.depth, self.min_ratio, self.min_arm, self.seed = depth, min_sample_ratio_leaf, min_arm, seed

    def fit(self, df, Y, T, X, needcut_X=(), key=None, split=None):
        X, needcut_X = list(dict.fromkeys(X)), list(dict.fromkeys(needcut_X))
        check_columns(df, Y, T, X, needcut_X)
        if split is None and not key:
            raise ValueError("give key columns (or a split expression) for the honest split")
        self.spark = df.sparkSession
        self.edges = self._edges(df, needcut_X)
        plain = [x for x in X if x not in needcut_X]
        self.features = {x: F.col(x) for x in plain}
        self.features.update({f"{c}_buckets": cut_bins(c, self.edges[c]) for c in needcut_X})
        flag = as_column(split).cast("int") if split is not None else split_random(key, self.seed)
        work = df.select(
            F.col(Y).cast("double").alias("_y"), F.col(T).cast("int").alias("_t"), flag.alias("_test"),
            *[e.alias(n) for n, e in self.features.items()],
        ).dropna(subset=["_y", "_t", "_test"])
        self._cols = {n: F.col(f"`{n}`") for n in self.features}
        shrinks = self._overall(work)
        # effects and variances do not change under a shift; sums of squares keep their digits
        centered = work.withColumn("_y", F.col("_y") - F.lit(float(self.center)))
        groups = unit_rows(centered, ["_test", *self._cols.values()])
        if shrinks:
            groups = groups.groupBy("_test", "_t", *self._cols.values()).agg(
                F.sum("_n").alias("_n"), F.sum("_s").alias("_s"), F.sum("_q").alias("_q")).persist()
        self._grow(groups.where("_test = 0"))
        self._estimate(groups.where("_test = 1"))
        if shrinks:
            groups.unpersist()
        return self

    def _edges(self, df, needcut):
        """De-duplicated exact quantiles of all numeric features, from value counts made in one scan."""
        if not needcut:
            return {}
        found = discrete_quantiles(df, needcut, TREE_QUANTILES)
        return {c: sorted(set(found[c] or [0.0])) for c in needcut}

    def _overall(self, work):
        """Sizes, pooled ATE, ATE of the estimation half; whether collapsing equal
        feature rows pays (their number is estimated in the same scan)."""
        cells = [(half, arm) for half in (0, 1) for arm in (0, 1)]
        row = work.agg(
            *[F.expr(f"count_if(_test = {h} and _t = {a}) AS n{h}{a}") for h, a in cells],
            *[F.expr(f"sum(if(_test = {h} and _t = {a}, _y, 0D)) AS s{h}{a}") for h, a in cells],
            F.expr("count_if(_t not in (0, 1)) AS other"),
            F.approx_count_distinct(F.xxhash64("_test", "_t", *self._cols.values())).alias("distinct"),
        ).first()
        n = {k: row[f"n{k[0]}{k[1]}"] for k in cells}
        s = {k: row[f"s{k[0]}{k[1]}"] for k in cells}
        check_arms(n[0, 1] + n[1, 1], n[0, 0] + n[1, 0], row["other"])
        if not all(n.values()):
            raise ValueError("both halves need rows of both arms")
        self.train_n, self.test_n = n[0, 0] + n[0, 1], n[1, 0] + n[1, 1]
        arm = {a: (n[0, a] + n[1, a], s[0, a] + s[1, a]) for a in (0, 1)}
        self.ate_pooled = arm[1][1] / arm[1][0] - arm[0][1] / arm[0][0]
        self.ate_estimation = s[1, 1] / n[1, 1] - s[1, 0] / n[1, 0]
        self.center = (arm[0][1] + arm[1][1]) / (arm[0][0] + arm[1][0])
        return row["distinct"] * COLLAPSE_FACTOR <= self.train_n + self.test_n

    def _placed(self, rows, nodes, cols=None):
        """``rows`` with ``_node``, the deepest node of each: a CASE over the features; splits of many values are joined, one join a level."""
        cols = cols or self._cols
        if not any(n.sides is not None for n in nodes.values()):
            return rows.withColumn("_node", self._membership(nodes, cols))
        rows = rows.withColumn("_node", F.lit(1))
        for level in range(max(n.level for n in nodes.values())):
            split = [n for n in nodes.values() if n.level == level and not n.is_leaf]
            value = F.lit(None).cast("string")
            for n in split:
                value = F.when(F.col("_node") == n.node_id, cols[n.feature].cast("string")).otherwise(value)
            left = F.lit(False)
            for n in split:
                if n.sides is None:
                    left = F.when(F.col("_node") == n.node_id, F.col("_value").isin(n.left_values)).otherwise(left)
            rows = rows.withColumn("_value", value)
            wide = [n.sides for n in split if n.sides is not None]
            if wide:
                table = wide[0]
                for more in wide[1:]:
                    table = table.unionByName(more)
                table = table.where("left").select(F.col("node").alias("_of"), F.col("value").alias("_is"), F.lit(True).alias("_left"))
                rows = rows.join(table, (F.col("_node") == F.col("_of")) & (F.col("_value") == F.col("_is")), "left").drop("_of", "_is")
                left = left | F.coalesce("_left", F.lit(False))
            rows = rows.withColumn("_node", F.when(F.col("_value").isNull(), F.col("_node")).otherwise(2 * F.col("_node") + F.when(left, 0).otherwise(1)))
            rows = rows.drop("_value", "_left")
        return rows

    def _membership(self, nodes, cols):
        """Deepest node of a row as a CASE expression over the features."""
        def walk(node):
            if node.is_leaf:
                return F.lit(node.node_id)
            value = cols[node.feature].cast("string")
            left, right = nodes[2 * node.node_id], nodes[2 * node.node_id + 1]
            return (
                F.when(value.isin(node.left_values), walk(left))
                .when(value.isNotNull(), walk(right))
                .otherwise(F.lit(node.node_id))
            )
        return walk(nodes[1])

    def _grow(self, train):
        nodes = {1: Node(1, 0, ())}
        open_nodes, gains, totals = [1], {}, None
        for _ in range(self.depth):
            member = F.col("_node")
            cells = cell_sums(self._placed(train, nodes), F.when(member.isin(open_nodes), member), self._cols).persist()
            splits, totals = self._split_level(cells, {n: nodes[n].impurity for n in open_nodes}, gains, totals)
            cells.unpersist()
            open_nodes = []
            for s in splits:
                node = nodes[s["node"]]
                node.feature, node.gain = s["feature"], s["gain"]
                node.left_values, node.right_values = sorted(s["left"]), sorted(s["right"])
                node.sides, node.size = s["sides"], s["size"]
                if node.impurity is None:
                    node.impurity = s["left_effect"] + s["right_effect"] - s["gain"]
                for child, op, effect in ((2 * node.node_id, "in", s["left_effect"]),
                                          (2 * node.node_id + 1, "not in", s["right_effect"])):
                    rule = (node.feature, op, node.left_values if node.sides is None else node.size)
                    nodes[child] = Node(child, node.level + 1, (*node.path, rule), effect)
                    open_nodes.append(child)
            if not open_nodes:
                break
        self.nodes_by_id = nodes
        self.importance = gains

    def _split_level(self, cells, impurity, gains, totals):
        """Best split per open node; adds positive gains to the importances.

        ``totals`` of the open nodes are counted at the root and follow from the
        parent's winning feature below it; returns the splits and those totals.
        """
        parents = {}
        for node, r in (node_totals(cells) if totals is None else totals).items():
            n = r["n1"] + r["n0"]
            # stop rules: too small, an empty arm, or no variance in an arm
            flat = any(
                r[f"n{i}"] == 0 or (r[f"n{i}"] > 1 and r[f"y{i}_sq"] - r[f"y{i}"] ** 2 / r[f"n{i}"] <= 1e-12 * r[f"y{i}_sq"])
                for i in (0, 1)
            )
            if not flat and n >= self.min_ratio * self.train_n:
                parents[node] = (n, r["effect"] if impurity[node] is None else impurity[node])
        if not parents:
            return [], {}
        candidates = split_candidates(cells, parents, self.train_n, self.min_ratio, self.min_arm)
        # one row per node and feature
        top = candidates.where("gain > 0").groupBy("node", "feature").agg(
            F.sum("gain").alias("total"),
            F.expr("max_by(struct(gain, tau, value, left_effect, right_effect), struct(gain, -rank))").alias("best"),
        ).collect()
        best = {}
        for r in sorted(top, key=lambda r: (r["node"], r["feature"])):
            gains[r["feature"]] = gains.get(r["feature"], 0.0) + r["total"]
            if r["node"] not in best or r["best"]["gain"] > best[r["node"]]["best"]["gain"]:
                best[r["node"]] = r
        if not best:
            return [], {}
        # categories of the winners: left of the cut in (effect desc, value) order
        tau = F.col("y1") / F.col("n1") - F.col("y0") / F.col("n0")
        is_left, won = F.lit(None).cast("boolean"), F.lit(False)
        for node, r in best.items():
            b = r["best"]
            mine = (F.col("node") == node) & (F.col("feature") == r["feature"])
            won = won | mine
            cut = F.lit(b["tau"])
            is_left = F.when(mine, (tau > cut) | ((tau == cut) & (F.col("value") <= b["value"]))).otherwise(is_left)
        # values seen in one arm only have no effect: they go right, but are no category
        one_arm = (F.col("n1") == 0) | (F.col("n0") == 0)
        chosen = cells.where(won).select("node", "value", one_arm.alias("one_arm"), *SUMS, F.when(one_arm, F.lit(False)).otherwise(is_left).alias("left"))
        sums = chosen.groupBy("node", "left").agg(F.count(F.lit(1)).alias("size"), *[F.sum(c).alias(c) for c in SUMS]).collect()
        below = {2 * r["node"] + (not r["left"]): {c: r[c] for c in SUMS} for r in sums}
        size = {node: sum(r["size"] for r in sums if r["node"] == node) for node in best}
        listed = [n for n in best if size[n] <= LISTED_VALUES]
        values = chosen.where(F.col("node").isin(listed)).select("node", "value", "one_arm", "left").collect() if listed else []
        out = []
        for node, r in sorted(best.items()):
            b = r["best"]
            for child in (2 * node, 2 * node + 1):
                below.setdefault(child, dict.fromkeys(SUMS, 0))
            out.append({
                "node": node, "feature": r["feature"], "gain": b["gain"],
                "left_effect": b["left_effect"], "right_effect": b["right_effect"],
                "left": [v["value"] for v in values if v["node"] == node and v["left"]],
                "right": [v["value"] for v in values if v["node"] == node and not v["left"] and not v["one_arm"]],
                "sides": None if node in listed else stored(chosen.where(F.col("node") == node).select("node", "value", "left", "one_arm")),
                "size": sum(x["size"] for x in sums if x["node"] == node and x["left"]),
            })
        return out, below

    def _estimate(self, test):
        """Arm moments per deepest node, merged upwards on the driver."""
        rows = self._placed(test, self.nodes_by_id).groupBy(F.col("_node").alias("node"), "_t").agg(
            F.sum("_n").alias("n"), F.sum("_s").alias("s"), F.sum("_q").alias("q")).collect()
        parts = {}
        for r in rows:
            mean = r["s"] / r["n"]
            m = Moments(r["n"], [mean + self.center], [[max(0.0, r["q"] - r["s"] * mean)]])
            node = r["node"]
            while node >= 1:
                parts.setdefault((node, r["_t"]), []).append(m)
                node //= 2
        out = []
        for node_id in sorted(self.nodes_by_id):
            node = self.nodes_by_id[node_id]
            feature, values = self._split_of(node)
            row = {
                "node_id": node_id, "parent": node_id // 2 or None, "level": node.level, "is_leaf": node.is_leaf,
                "split_feature": feature, "split_values": values, "rule": self._rule(node),
                "gain": node.gain, "impurity": node.impurity,
            }
            if (node_id, 1) in parts and (node_id, 0) in parts:
                m1, m0 = merge_all(parts[node_id, 1]), merge_all(parts[node_id, 0])
                row["ratio"] = (m1.n + m0.n) / self.test_n
                row.update(node_inference(m1, m0, self.ate_estimation, node_id == 1))
            out.append(row)
        for i in range(1, 5):
            p = [math.nan if r.get(f"pvalue{i}") is None else r[f"pvalue{i}"] for r in out]
            for r, q in zip(out, q_values(p)):
                r[f"qvalue{i}"] = None if math.isnan(q) else float(q)
        self._rows = out

    def _labels(self, feature, values):
        if feature.endswith("_buckets") and feature[:-8] in self.edges:
            labels = bin_labels(self.edges[feature[:-8]])
            return [labels[int(v) - 1] for v in sorted(values, key=int)]
        return list(values)

    def _split_of(self, node):
        """Feature and categories by which the parent sends rows here."""
        if node.node_id == 1:
            return None, None
        parent = self.nodes_by_id[node.node_id // 2]
        if parent.sides is not None:
            return parent.feature, None
        values = parent.left_values if node.node_id % 2 == 0 else parent.right_values
        return parent.feature, self._labels(parent.feature, values)

    def _rule(self, node):
        told = lambda f, v: f"{v} values" if isinstance(v, int) else ", ".join(self._labels(f, v))
        return " and ".join(f"{f} {op} ({told(f, v)})" for f, op, v in node.path)

    def wide_splits(self):
        """(node_id, feature, value, is_left) of the splits of more values than a node's row lists; values of one arm only are left out."""
        tables = [n.sides.where("not one_arm").select(F.col("node").alias("node_id"), F.lit(n.feature).alias("feature"), "value", F.col("left").alias("is_left"))
                  for n in self.nodes_by_id.values() if n.sides is not None]
        if not tables:
            return self.spark.createDataFrame([], "node_id int, feature string, value string, is_left boolean")
        out = tables[0]
        for more in tables[1:]:
            out = out.unionByName(more)
        return out

    def nodes(self):
        """One row per node: split, sizes, four effect scales, q-values."""
        names = [f.split()[0] for f in NODE_SCHEMA.split(", ")]
        return self.spark.createDataFrame([tuple(r.get(n) for n in names) for r in self._rows], NODE_SCHEMA)

    def feature_importance(self):
        rows = [(f, float(g)) for f, g in self.importance.items()]
        return self.spark.createDataFrame(rows, "feature string, importance double")

    def effect(self, df, name="effect", default=None):
        """Append the estimated effect of the leaf a row falls into."""
        leaves = {r["node_id"]: r.get("prediction") for r in self._rows if r["is_leaf"]}
        nodes = self.nodes_by_id
        if any(n.sides is not None for n in nodes.values()):
            # the user's row travels as one column, so that no name of it can clash
            names = [f"_f{i}" for i in range(len(self.features))]
            whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[e.alias(n) for e, n in zip(self.features.values(), names)])
            placed = self._placed(whole, nodes, {f: F.col(n) for f, n in zip(self.features, names)})
            score = F.element_at(F.create_map(*[x for n, v in leaves.items() for x in (F.lit(n), F.lit(v).cast("double"))]), F.col("_node"))
            score = F.when(F.col("_node").isin(list(leaves)), score)
            return placed.select("_row.*", (score if default is None else F.coalesce(score, F.lit(float(default)))).alias(name))
        cols = {n: e.cast("string") for n, e in self.features.items()}

        def walk(node):
            if node.is_leaf:
                return F.lit(leaves[node.node_id]).cast("double")
            value = cols[node.feature]
            return (
                F.when(value.isin(node.left_values), walk(nodes[2 * node.node_id]))
                .when(value.isNotNull(), walk(nodes[2 * node.node_id + 1]))
            )
        score = walk(nodes[1])
        return df.withColumn(name, score if default is None else F.coalesce(score, F.lit(float(default))))

    def curve(self):
        """Leaf-level lift and gain against random targeting."""
        return tree_curve(self.nodes())


def tree_curve(nodes):
    """ratio, toc_tree, toc_random, qini_tree, qini_random over the leaves of a
    node table (at most 2**depth rows, hence one window)."""
    leaves = nodes.where(F.col("is_leaf") & F.col("prediction").isNotNull())
    order = W.partitionBy(F.lit(0)).orderBy(F.col("prediction").desc(), "node_id")
    upto = order.rowsBetween(W.unboundedPreceding, 0)
    n1, n0 = F.col("treated_count"), F.col("control_count")
    cum = leaves.select(
        "prediction", "node_id",
        F.sum(n1 + n0).over(upto).alias("n"), F.sum(n1).over(upto).alias("n1"), F.sum(n0).over(upto).alias("n0"),
        F.sum(n1 * F.col("treated_avg")).over(upto).alias("y1"),
        F.sum(n0 * F.col("control_avg")).over(upto).alias("y0"),
    )
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    toc = F.col("y1") / F.col("n1") - F.col("y0") / F.col("n0")
    qini = F.col("y1") - F.col("y0") / F.col("n0") * F.col("n1")
    curve = cum.select("prediction", "node_id", (F.col("n") / F.last("n").over(whole)).alias("ratio"),
                       toc.alias("toc_tree"), qini.alias("qini_tree"))
    return curve.select(
        "ratio", "toc_tree", F.last("toc_tree").over(whole).alias("toc_random"), "qini_tree",
        (F.col("ratio") * F.last("qini_tree").over(whole)).alias("qini_random"),
    )
