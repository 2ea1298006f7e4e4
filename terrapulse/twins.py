"""Common table expressions for DuckDB that several twins share."""

from __future__ import annotations

#: ``r``: obs with ``fit, res, model, break_idx, delta_bic, model_rms``; ``mp``: one row a point, to be read at any date by :func:`value_at`.
MODEL = """k0 AS (SELECT *, day_offset / 365.25::DOUBLE AS t, sin(2 * pi() * day_offset / 365.25::DOUBLE) AS s, cos(2 * pi() * day_offset / 365.25::DOUBLE) AS c FROM obs),
k1 AS (SELECT *, avg(t) OVER p AS mt, avg(value_mm) OVER p AS my, avg(s) OVER p AS ms, avg(c) OVER p AS mc, count(*) OVER p AS n, row_number() OVER (PARTITION BY point_id ORDER BY epoch_idx) - 1 AS i FROM k0 WINDOW p AS (PARTITION BY point_id)),
k2 AS (SELECT *, t - mt AS dt, value_mm - my AS dy, s - ms AS ds, c - mc AS dc FROM k1),
k3 AS (SELECT *, sum(dt * dt) OVER p AS tt, coalesce(sum(dt * dy) OVER p / nullif(sum(dt * dt) OVER p, 0), 0) AS b, coalesce(sum(dt * ds) OVER p / nullif(sum(dt * dt) OVER p, 0), 0) AS ks, coalesce(sum(dt * dc) OVER p / nullif(sum(dt * dt) OVER p, 0), 0) AS kc,
 sum(ds * ds) OVER p AS s0, sum(dc * dc) OVER p AS c0 FROM k2 WINDOW p AS (PARTITION BY point_id)),
k4 AS (SELECT *, dy - b * dt AS e, ds - ks * dt AS s1, dc - kc * dt AS c1 FROM k3),
k5 AS (SELECT *, sum(e * e) OVER p AS line, sum(s1 * s1) OVER p AS ss, sum(s1 * e) OVER p AS sr, sum(s1 * c1) OVER p AS sc, count(*) OVER q AS qn, sum(dt) OVER q AS qt, sum(dt * dt) OVER q AS qtt, sum(e) OVER q AS qr, sum(e * dt) OVER q AS qrt
 FROM k4 WINDOW p AS (PARTITION BY point_id), q AS (PARTITION BY point_id ORDER BY epoch_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
k6 AS (SELECT *, CASE WHEN ss > 1e-12 * s0 THEN sr / ss ELSE 0 END AS al, CASE WHEN ss > 1e-12 * s0 THEN sc / ss ELSE 0 END AS rho, qrt - dt * qr AS hr, qt - dt * qn AS h, qtt - dt * qt AS ht, qtt - 2 * dt * qt + dt * dt * qn AS h0 FROM k5),
k7 AS (SELECT *, c1 - rho * s1 AS c2, h0 - h * h / n - coalesce(ht * ht / nullif(tt, 0), 0) AS hh, coalesce(ht / nullif(tt, 0), 0) AS eta FROM k6),
k8 AS (SELECT *, sum(c2 * c2) OVER p AS cc, sum(c2 * e) OVER p AS cr, CASE WHEN hh > 1e-12 * h0 THEN hr / hh ELSE 0 END AS de FROM k7 WINDOW p AS (PARTITION BY point_id)),
k9 AS (SELECT *, CASE WHEN cc > 1e-12 * c0 THEN cr / cc ELSE 0 END AS be, CASE WHEN n >= 5 AND i >= 3 AND i < greatest(4, n - 3) THEN round(n * ln(greatest(greatest(line - de * hr, 0) / n, 1e-6)) + 3 * ln(n), 6) END AS hb FROM k8),
k10 AS (SELECT *, min({'b': hb, 'i': i, 'd': dt, 'de': de, 'mean': h / n, 'eta': eta}) FILTER (hb IS NOT NULL) OVER (PARTITION BY point_id) AS br, round(n * ln(greatest(line / n, 1e-6)) + 2 * ln(n), 6) AS b1, round(n * ln(greatest(greatest(line - al * sr - be * cr, 0) / n, 1e-6)) + 4 * ln(n), 6) AS b2 FROM k9),
k11 AS (SELECT *, br.b AS b3, CASE WHEN b1 <= b2 AND b1 <= coalesce(br.b, b1) THEN 1 WHEN b2 <= coalesce(br.b, b2) THEN 2 ELSE 3 END AS best FROM k10),
k12 AS (SELECT *, my + b * dt + CASE best WHEN 2 THEN al * s1 + be * c2 WHEN 3 THEN br.de * (greatest(dt - br.d, 0) - br.mean - br.eta * dt) ELSE 0 END AS fit, list_sort(list_filter([b1, b2, b3], lambda x: x IS NOT NULL)) AS bs FROM k11),
r AS (SELECT point_id, epoch_idx, date, day_offset, value_mm, fit, value_mm - fit AS res, CASE best WHEN 1 THEN 'linear' WHEN 2 THEN 'linear_annual' ELSE 'piecewise' END AS model, CAST(CASE WHEN best = 3 THEN br.i ELSE -1 END AS INTEGER) AS break_idx,
 bs[2] - bs[1] AS delta_bic, sqrt(avg((value_mm - fit) ** 2) OVER (PARTITION BY point_id)) AS model_rms FROM k12),
mp AS (SELECT point_id, first(best) AS best, first(my) AS my, first(mt) AS mt, first(b) AS b, first(al) AS al, first(be) AS be, first(rho) AS rho, first(ks) AS ks, first(kc) AS kc, first(ms) AS ms, first(mc) AS mc, first(br) AS br FROM k12 GROUP BY point_id),
og AS (SELECT min(date) AS origin FROM epoch)"""


def value_at(day: str) -> str:
    """Value of a row of ``mp`` at a date (with ``og`` in scope)."""
    t = f"(datediff('day', origin, {day}) / 365.25::DOUBLE)"
    left = f"(sin(2 * pi() * {t}) - mp.ms - mp.ks * ({t} - mp.mt))"
    wave = f"mp.al * {left} + mp.be * (cos(2 * pi() * {t}) - mp.mc - mp.kc * ({t} - mp.mt) - mp.rho * {left})"
    bent = f"mp.br.de * (greatest({t} - mp.mt - mp.br.d, 0) - mp.br.mean - mp.br.eta * ({t} - mp.mt))"
    return f"(mp.my + mp.b * ({t} - mp.mt) + CASE mp.best WHEN 2 THEN {wave} WHEN 3 THEN {bent} ELSE 0 END)"
