"""SQL text for the DuckDB oracles of the window features."""

from __future__ import annotations


def _part(keys):
    return ", ".join(keys)


def lag_sql(keys, target, lag, src=None):
    src = src or target
    return f"lag({src}, {lag}) OVER (PARTITION BY {_part(keys)} ORDER BY date)"


def roll_sql(keys, target, stat, lag, win, digits=6):
    fn = {"mean": "avg", "std": "stddev_samp"}[stat]
    frame = (f"OVER (PARTITION BY {_part(keys)} ORDER BY date "
             f"ROWS BETWEEN {lag + win - 1} PRECEDING AND {lag} PRECEDING)")
    return (f"round(CASE WHEN count({target}) {frame} = {win} THEN {fn}({target}) {frame} END, {digits}) + 0.0"
            f" AS {target}_roll_{stat}_lag_{lag}_win_{win}")


def alpha_tag(alpha):
    return str(alpha).replace(".", "")


def enc_sql(target, cols, src="dense"):
    name = "_".join(cols)
    on = " AND ".join(f"d.{c} = e.{c}" for c in cols)
    mean = f"CAST(sum(CAST({target} AS DECIMAL(38,10))) AS DOUBLE) / count({target})"  # exact, whatever the order
    return (f"LEFT JOIN (SELECT {', '.join(cols)}, {mean} AS enc_{name}_mean, "
            f"stddev_samp({target}) AS enc_{name}_std FROM {src} GROUP BY {', '.join(cols)}) e_{name} "
            f"ON {on.replace('e.', f'e_{name}.')}")


def ewm_recursive_sql(keys, alphas, src="dense", out="eb", extra=""):
    """CTEs computing the EWM with the same IEEE update as pandas' ewm mean
    (weighted running mean w, decaying weight o), so the doubles are
    bit-identical and rounding agrees even on exact decimal ties.

    Produces CTE ``out`` with keys, date, qty and ``e_{alpha}`` columns.
    Requires a null-free target (a dense, zero-filled panel).
    """
    k = ", ".join(keys)
    on = " AND ".join(f"e.{c} = r.{c}" for c in keys)
    tags = [alpha_tag(a) for a in alphas]
    decays = [repr(1.0 - 1.0 / (1.0 + (1.0 - a) / a)) for a in alphas]
    first = ", ".join(f"qty AS w_{t}, 1.0::DOUBLE AS o_{t}" for t in tags)
    step = ", ".join(
        f"CASE WHEN r.w_{t} <> e.qty THEN (r.o_{t} * {d} * r.w_{t} + e.qty) / (r.o_{t} * {d} + 1.0) "
        f"ELSE r.w_{t} END AS w_{t}, r.o_{t} * {d} + 1.0 AS o_{t}"
        for t, d in zip(tags, decays))
    ratio = ", ".join(f"w_{t} AS e_{t}" for t in tags)
    return f"""
_seq AS (SELECT {k}, date, qty{extra}, row_number() OVER (PARTITION BY {k} ORDER BY date) AS rn FROM {src}),
_rec AS (SELECT {k}, rn, {first} FROM _seq WHERE rn = 1
         UNION ALL
         SELECT {', '.join('e.' + c for c in keys)}, e.rn, {step}
         FROM _rec r JOIN _seq e ON {on} AND e.rn = r.rn + 1),
{out} AS (SELECT s.*, {ratio} FROM _seq s JOIN _rec USING ({k}, rn))"""
