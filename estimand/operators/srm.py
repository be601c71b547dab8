"""Sample-ratio mismatch test."""

from pyspark.sql import functions as F

from estimand.functions import dist
from estimand.functions.columns import as_column, as_double
from estimand.plans.finalize import finalize
from estimand.plans.prefix import stored
from estimand.plans.segments import Groups, with_totals

# Fixed value: the smallest usable total, expectation, statistic.
TINY = 1e-6


def chi_square(observed, ratios):
    """(chi-square, p, None) or (None, None, reason)."""
    if len(observed) != len(ratios):
        return None, None, "the number of groups must equal the number of ratios"
    if not observed:
        return None, None, "the table is empty"
    total_ratio, total = sum(ratios), sum(observed)
    if abs(total_ratio) <= TINY:
        return None, None, "the ratios must not sum to zero"
    expected = [r / total_ratio * total for r in ratios]
    if min(expected) <= TINY:
        return None, None, "expected counts must be positive"
    chi2 = sum((o - e) ** 2 / e for o, e in zip(observed, expected))
    if chi2 <= TINY:
        return None, None, "chi-square is zero"
    return chi2, dist.chi2_sf(chi2, len(observed) - 1), None


def srm(df, value, group, ratios):
    """Chi-square of the per-group sums of ``value`` against ``ratios``.

    ``ratios`` is a list in group-key order or a dict keyed by group.  One row
    per group; unusable input gives a ``message`` instead of a statistic.
    """
    sums = (
        df.select(as_column(group).alias("groupname"), as_double(value).alias("_v"))
        .dropna()
        .groupBy("groupname")
        .agg(F.sum("_v").alias("f_obs"))
    )
    sums = stored(sums)
    found = sums.limit(len(ratios) + 1).count()
    if found > len(ratios):
        reason = chi_square([1.0] * found, list(range(len(ratios))))[2]
        none = F.lit(None).cast("double")
        return sums.select(F.col("groupname").cast("string").alias("groupname"), "f_obs", none.alias("ratio"), none.alias("chisquare"),
                           none.alias("p_value"), F.lit(reason).alias("message"))
    # as many cells at most as the caller has ratios
    packed = sums.agg(F.sort_array(F.collect_list(F.struct("groupname", "f_obs"))).alias("cells"))
    return finalize(packed, _judged(ratios), SRM_SCHEMA)


SRM_SCHEMA = "groupname string, f_obs double, ratio double, chisquare double, p_value double, message string"


def _judged(ratios, keys=()):
    """Rows of one test from its cells; ``keys`` are carried along."""

    def fn(row):
        cells = list(row["cells"])
        if isinstance(ratios, dict):
            named = {str(k): float(v) for k, v in ratios.items()}
            wanted = [named[str(c["groupname"])] for c in cells if str(c["groupname"]) in named]
            wanted = wanted if len(named) == len(cells) else []
        else:
            wanted = [float(r) for r in ratios]
        chi2, p, message = chi_square([c["f_obs"] for c in cells], wanted)
        for i, c in enumerate(cells):
            yield {
                **{k: row[k] for k in keys}, "groupname": str(c["groupname"]), "f_obs": c["f_obs"],
                "ratio": wanted[i] if i < len(wanted) else None,
                "chisquare": chi2, "p_value": p, "message": message,
            }

    return fn


def srm_grouped(df, value, group, ratios, by):
    """(by.., groupname, f_obs, ratio, chisquare, p_value, message): ``srm`` in every group of ``by``.

    A group with more cells than ratios has the message alone, its cells are not put together.
    """
    groups = Groups(by)
    rows = df.select(*groups.columns(), as_column(group).alias("groupname"), as_double(value).alias("_v")).dropna(subset=["groupname", "_v"])
    sums = rows.groupBy(*groups.names, "groupname").agg(F.sum("_v").alias("f_obs"))
    sums = stored(sums)
    sized = with_totals(sums, groups.names, cells_=F.count(F.lit(1)))
    fit = sized.where(F.col("cells_") <= len(ratios))
    packed = fit.groupBy(*groups.names).agg(F.sort_array(F.collect_list(F.struct("groupname", "f_obs"))).alias("cells"))
    schema = groups.schema(packed) + SRM_SCHEMA
    found = finalize(packed, _judged(ratios, groups.names), schema)
    none = F.lit(None).cast("double")
    reason = chi_square([1.0] * (len(ratios) + 1), list(range(len(ratios))))[2]
    many = sized.where(F.col("cells_") > len(ratios)).select(
        *groups.names, F.col("groupname").cast("string").alias("groupname"), "f_obs", none.alias("ratio"), none.alias("chisquare"), none.alias("p_value"), F.lit(reason).alias("message"))
    return found.unionByName(many).select(*groups.restored(), "groupname", "f_obs", "ratio", "chisquare", "p_value", "message")
