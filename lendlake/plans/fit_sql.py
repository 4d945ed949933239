"""SQL text of the model's fit and calibration: Newton steps and the isotonic fit as plain relations.

The check of the fitted queries. A Newton step groups products of features over the rows, and
solves its system by eliminating one row after the other; the isotonic fit walks along the
convex minorant of the summed outcomes, one block a step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence


def newton_sql(
    source: str, numeric: Sequence[str], levels: Mapping[str, Sequence[str]], target: str, where: str, steps: int = 12
) -> tuple[str, list[str], str]:
    """Common table expressions that end in ``fitted(b)``, the coefficients' names, and the text of a row's vector.

    ``fit_stat`` holds means and deviations of the training rows (``where``) of ``source``.
    """
    stat = ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in numeric)
    vector = [f"({c} - m_{c}) / case when s_{c} = 0 then 1e0 else s_{c} end" for c in numeric]
    names = [f"num__{c}" for c in numeric]
    for c, of_column in levels.items():
        for level in of_column:
            text = f"case when {c} then 'True' else 'False' end" if level in ("True", "False") else c
            vector.append(f"case when {text} = '{level}' then 1e0 else 0e0 end")
            names.append(f"cat__{c}_{level}")
    names.append("(intercept)")
    x = f"[{', '.join([*vector, '1e0'])}]"
    d = len(names)
    parts = [
        f"fit_train as materialized (select *, cast({target} as int) as y from {source} where {where})",
        f"fit_stat as materialized (select count(*) * 1e0 as n_all, sum(y) * 1e0 as n_one, {stat} from fit_train)",
        f"""fit_rows as materialized (select {x} as x, y, n_all / (2e0 * case when y = 1 then n_one else n_all - n_one end) as s
            from fit_train cross join fit_stat)""",
        f"fit_places as materialized (select unnest(range(1, {d + 1})) as i)",
        f"fit_b0 as materialized (select list_transform(range(1, {d + 1}), lambda i: 0e0) as b)",
    ]
    for k in range(1, steps + 1):
        parts += [
            f"""fit_e{k} as materialized (select x, s * (p - y) as g, s * p * (1e0 - p) as h from (
              select x, y, s, 1e0 / (1e0 + exp(-list_dot_product(x, b))) as p from fit_rows cross join fit_b{k - 1}))""",
            f"""fit_h{k} as materialized (select a.i as i, c.i as j, sum(h * x[a.i] * x[c.i]) as v
              from fit_e{k} cross join fit_places a cross join fit_places c where a.i <= c.i group by 1, 2)""",
            f"""fit_m{k} as materialized (select i, list(v order by j) as r from (
              select i, j, v + case when i = j and i < {d} then 1e0 else 0e0 end as v from fit_h{k}
              union all select j, i, v from fit_h{k} where i < j
              union all select i, {d + 1}, sum(g * x[i]) + any_value(case when i < {d} then b[i] else 0e0 end)
                from fit_e{k} cross join fit_places cross join fit_b{k - 1} group by i) group by i)""",
            f"""fit_s{k}(step, i, r) as (select 0, i, r from fit_m{k} union all
              select step + 1, i, case when i = step + 1 then list_transform(pr, lambda v: v / d)
                else list_transform(list_zip(r, pr), lambda t: t[1] - f * t[2]) end
              from (select e.step, e.i, e.r, p.r as pr, p.r[p.i] as d, e.r[p.i] / p.r[p.i] as f
                from fit_s{k} e join fit_s{k} p on p.i = e.step + 1 where e.step < {d}))""",
            f"""fit_b{k} as materialized (select list(b[i] - r[{d + 1}] order by i) as b
              from fit_s{k} cross join fit_b{k - 1} where step = {d})""",
        ]
    parts.append(f"fitted as materialized (select b from fit_b{steps})")
    return ",\n".join(parts), names, x


def isotonic_sql(groups: str, prefix: str = "iso") -> str:
    """Common table expressions that end in ``<prefix>_fit(score, w, calibrated)``.

    ``groups`` has (score, w, y): rows and sum of the outcomes of each distinct score. A block ends
    where the line from its beginning is least steep (the last such place).
    """
    return f"""{prefix}_points as materialized (select score, w, row_number() over (order by score) as place,
        sum(w) over (order by score) as cw, sum(y) over (order by score) as cy from ({groups})),
      {prefix}_hull(place, cw, cy, slope) as (select cast(0 as bigint), 0e0, 0e0, 0e0 union all
        select cast(e.p as bigint), cast(e.w as double), cast(e.y as double), cast(e.m as double) from (
          select arg_min(struct_pack(p := q.place, w := q.cw, y := q.cy, m := (q.cy - h.cy) / (q.cw - h.cw)),
            struct_pack(m := (q.cy - h.cy) / (q.cw - h.cw), p := -q.place)) as e
          from {prefix}_hull h join {prefix}_points q on q.place > h.place having count(*) > 0)),
      {prefix}_fit as materialized (select p.score, p.w, h.slope as calibrated from {prefix}_points p
        asof join {prefix}_hull h on p.place <= h.place)"""
