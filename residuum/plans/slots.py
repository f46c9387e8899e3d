"""All feature slots and all strata of pocket hits, on the line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from residuum.operators import aggregates
from residuum.plans.catalog import query, table

c = F.col
#: Added before rounding on both sides: means of a few short decimals often lie on the edge between two.
TIE = 1e-8


def _cell(i: int, kind: str) -> str:
    """Column i of the features, as text that both engines read; every so many values is null."""
    value = {
        "distance": f"l_quantity / 5 + {i}", "number": f"l_extendedprice / {1000 + i}", "exposure": f"l_discount * {2 + i % 3}", "probability": "'x'", "flag": f"l_orderkey % {2 + i % 5} = 0", "category": "l_returnflag",
    }[kind]
    return f"CASE WHEN l_linenumber % 7 <> {i % 7} THEN {value} END"


@query("structural_features", f"""
    WITH r AS (SELECT l_partkey, l_quantity / 50 AS quality, 1 - l_discount * 5 AS coverage, {', '.join(f'{_cell(i, k)} AS "{n}"' for i, (n, k) in enumerate(aggregates.STRUCTURAL.items()))} FROM lineitem),
    v AS (SELECT l_partkey, ssa, sum(quality) AS w FROM r GROUP BY ALL), m AS (SELECT l_partkey, arg_min(coalesce(ssa, ''), {{'w': -w, 'n': coalesce(ssa, '')}}) AS ssa FROM v GROUP BY 1)
    SELECT r.l_partkey, nullif(any_value(m.ssa), '') AS ssa, {', '.join({
        "distance": f'round(sum(CASE WHEN "{n}" <= 8 THEN "{n}" * quality END) / sum(CASE WHEN "{n}" <= 8 THEN quality END) + {TIE}, 6)', "number": f'round(sum("{n}" * quality) / sum(CASE WHEN "{n}" IS NOT NULL THEN quality END) + {TIE}, 6)',
        "probability": f'round(count("{n}") / count(*) + {TIE}, 6)', "flag": f'round(sum(CASE WHEN "{n}" THEN 1 ELSE 0 END) / count(*) + {TIE}, 6)', "exposure": f'round(sum("{n}" * quality * coverage ** 2) / nullif(sum(CASE WHEN "{n}" IS NOT NULL THEN quality * coverage ** 2 END), 0) + {TIE}, 6)',
    }[k] + f' AS "{n}"' for n, k in aggregates.STRUCTURAL.items() if k != "category")}
    FROM r JOIN m ON m.l_partkey = r.l_partkey GROUP BY r.l_partkey""")  # fmt: skip
def structural_features(spark, sf_dir):
    """All 36 slots; a coverage of zero weighs nothing in the exposures."""
    cells = [F.expr(_cell(i, k)).alias(n) for i, (n, k) in enumerate(aggregates.STRUCTURAL.items())]
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", (c("l_quantity") / 50).alias("quality"), (1 - c("l_discount") * 5).alias("coverage"), *cells)
    found = aggregates.structural_features(rows, ["l_partkey"])
    return found.select("l_partkey", "ssa", *(F.round(c(n) + TIE, 6).alias(n) for n, k in aggregates.STRUCTURAL.items() if k != "category"))


HITS = "SELECT l_suppkey AS k, CAST(l_orderkey % 9 AS INTEGER) AS query, CAST(l_partkey % 9 AS INTEGER) AS hit, l_quantity / 50 AS site_identity, 0.4 + l_discount * 6 AS identity, l_tax AS bb_rmsd, l_extendedprice AS all_rmsd, l_linenumber AS n_site, l_discount AS site_lddt FROM lineitem"
BANDS = {"seq": ("identity", aggregates.FULL_CLASSES), "site": ("site_identity", aggregates.SITE_CLASSES)}


def _band(which: str, band: str) -> str:
    x, (high, low) = BANDS[which]
    return {"high": f"{x} >= {high}", "middle": f"{x} < {high} AND {x} >= {low}", "low": f"{x} < {low}"}[band]


STRATA = {f"{w}_{b}": _band(w, b) for w in BANDS for b in ("high", "middle", "low")} | {f"seq_{a}_site_{b}": f"{_band('seq', a)} AND {_band('site', b)}" for a in ("high", "middle", "low") for b in ("high", "middle", "low")}


@query("pocket_strata", f"""
    WITH h AS ({HITS})
    SELECT k, {', '.join(f"round(avg({v}) FILTER ({cond}) + {TIE}, 5) AS {n}_{v}" for n, cond in STRATA.items() for v in aggregates.POCKET_VALUES)},
      {', '.join(f"round(sum({v} * ({w})) / sum({w}) + {TIE}, 5) AS {n}_{v}" for n, w in (("alike", "site_identity * identity"), ("unlike", "(1.5 - site_identity) * (1.5 - identity)")) for v in aggregates.POCKET_VALUES)}
    FROM h WHERE query <> hit GROUP BY k""")  # fmt: skip
def pocket_strata(spark, sf_dir):
    i = table(spark, sf_dir, "lineitem")
    hits = i.select(c("l_suppkey").alias("k"), (c("l_orderkey") % 9).alias("query"), (c("l_partkey") % 9).alias("hit"), (c("l_quantity") / 50).alias("site_identity"), (0.4 + c("l_discount") * 6).alias("identity"), c("l_tax").alias("bb_rmsd"), c("l_extendedprice").alias("all_rmsd"), c("l_linenumber").alias("n_site"), c("l_discount").alias("site_lddt"))
    found = aggregates.pocket_strata(hits, ["k"])
    return found.select("k", *(F.round(c(x) + TIE, 5).alias(x) for x in found.columns if x != "k"))
