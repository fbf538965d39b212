"""DuckDB SQL for every registered query (the cross-engine check).

Each query is stated independently of the Spark code path: geometry by
brute force over grid cells (closed-box tests written out), nearest
indices by ranking every axis value, windows where Spark uses joins.
Inputs are the same fixture rules as ``sources.fixtures``, as CTEs over
the driver tables (pre-registered views), whole tables.
"""

from __future__ import annotations

from cellflux import factors

# ---------------------------------------------------------------------------
# fixtures
# ---------------------------------------------------------------------------

FIXTURES: dict[str, str] = {
    "readings": """SELECT event_id AS sno, user_id AS station_id, ts,
        concat(substr(cast(ts AS string),1,10),'T',substr(cast(ts AS string),12,5)) AS time,
        cast(floor(value*100e0) AS bigint) AS pm05, cast(floor(value*10e0) AS bigint) AS pm25 FROM events""",
    "weather": """SELECT DISTINCT cast(ts AS date) AS date, cast((dayofmonth(ts)*37)%101 AS double) + CASE WHEN dayofmonth(ts)%3=2 THEN 0.5e0 ELSE 0e0 END AS hum
        FROM events WHERE dayofmonth(ts)<=27""",
    "grid": """SELECT cast(gid AS int) AS gid, cast(floor((gid-1)/50) AS int) AS ix, cast((gid-1)%50 AS int) AS iy
        FROM range(1,3001) AS t(gid)""",
    "industry": """SELECT p_partkey AS ind_id, (p_partkey*7919%60000)/1000e0 AS x, (p_partkey*104729%50000)/1000e0 AS y,
        p_retailprice AS pm10_emiss, cast(p_size AS double) AS pm25_emiss, p_size AS size FROM part""",
    "footprints": """SELECT ind_id, pm10_emiss, pm25_emiss, x - size/50e0 AS fx0, y - size/50e0 AS fy0,
        x + size/50e0 AS fx1, y + size/50e0 AS fy1 FROM industry""",
    "roads": """SELECT l_orderkey AS road_id, l_partkey AS seg_part, l_suppkey AS seg_supp,
        (l_orderkey*7919%57000)/1000e0 AS x0, (l_partkey*104729%47000)/1000e0 AS y0,
        (l_orderkey*7919%57000)/1000e0+(l_suppkey%30)/10e0 AS x1, (l_partkey*104729%47000)/1000e0+(l_partkey%30)/10e0 AS y1,
        CASE l_orderkey%6 WHEN 0 THEN 'trunk' WHEN 1 THEN 'primary' WHEN 2 THEN 'secondary' WHEN 3 THEN 'tertiary'
             WHEN 4 THEN 'residential' ELSE 'path' END AS cat FROM lineitem""",
    "wards": """SELECT n_nationkey AS wrd, n_name AS area_name, 12e0*(n_nationkey%5) AS x0, 10e0*floor(n_nationkey/5) AS y0,
        12e0*(n_nationkey%5)+12e0 AS x1, 10e0*floor(n_nationkey/5)+10e0 AS y1 FROM nation""",
    "census": """SELECT CASE WHEN c_nationkey%8=7 THEN c_nationkey+1000 ELSE c_nationkey END AS tvw, CASE WHEN c_nationkey%2=0 THEN 'Rural' ELSE 'Urban' END AS tru,
        cast(count(*)*37 AS bigint) AS no_of_households, 5e0+c_nationkey%3 AS s1, 10e0 AS s2, 15e0 AS s3, 25e0 AS s4,
        20e0-c_nationkey%3 AS s5, 15e0 AS s6, 10e0 AS s7 FROM customer GROUP BY c_nationkey""",
    "sector_fields": """SELECT l_returnflag AS species, l_linenumber AS sector, cast(month(l_shipdate) AS int) AS month,
        cast(l_suppkey%18 AS int) AS lat_idx, cast(l_partkey%36 AS int) AS lon_idx, l_extendedprice/1099511627776e0 AS emi FROM lineitem""",
    "lat_axis": "SELECT cast(i AS int) AS lat_idx, 10.05e0+i/10e0 AS lat FROM range(0,18) AS t(i)",
    "lon_axis": "SELECT cast(i AS int) AS lon_idx, 76.05e0+i/10e0 AS lon FROM range(0,36) AS t(i)",
    "stops": """SELECT p_partkey AS stop_id, concat('stop ',cast(p_partkey AS string)) AS stop,
        (p_partkey*7919%60000)/1000e0 AS x, (p_partkey*104729%50000)/1000e0 AS y FROM part
        UNION ALL SELECT p_partkey + 10000000, concat('stop ',cast(p_partkey AS string)),
        (p_partkey*6007%60000)/1000e0, (p_partkey*7001%50000)/1000e0 FROM part WHERE p_partkey%97=0""",
    "route_stops": """SELECT route, total_sing, cast(CASE WHEN route%50=0 AND rn>1 THEN rn+1 ELSE rn END AS int) AS pos, stop_key FROM (
        SELECT o_orderkey AS route, o_custkey%20 AS total_sing,
        row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn,
        concat('stop',cast(l_partkey AS string)) AS stop_key FROM orders JOIN lineitem ON o_orderkey=l_orderkey)
        UNION ALL SELECT o_orderkey, o_custkey%20, 2, 'nosuchstop' FROM orders WHERE o_orderkey%50=0
          AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey=o_orderkey)""",
    "observations": """SELECT cast(date_trunc('hour',ts) AS timestamp) AS time, event_type AS property, avg(value) AS value
        FROM events GROUP BY 1,2""",
    "stations": """SELECT cast(s_suppkey AS double) AS code, s_name AS name, 11e0+(s_suppkey%50)/100e0 AS lat,
        76e0+(s_suppkey%60)/100e0 AS lon, cast(400+s_suppkey%90 AS double) AS elevation FROM supplier""",
    "input_files": """SELECT DISTINCT concat(CASE WHEN event_type='error' THEN 'gfsanl_3_' ELSE 'namanl_218_' END,
        replace(substr(cast(ts AS string),1,10),'-',''),'_',substr(cast(ts AS string),12,2),'00_000.grb') AS path FROM events""",
    "run_log": """SELECT user_id AS run_id, event_id AS line_no,
        CASE WHEN event_id%7=0 THEN 'wrf: Successful completion' ELSE event_type END AS stage, ts FROM events""",
    "sites": """SELECT ind_id, pm10_emiss, pm25_emiss, x, y, size/25e0 AS a, size/40e0 AS b, x AS hx0, y - size/200e0 AS hy0,
        x + size/100e0 AS hx1, y + size/200e0 AS hy1 FROM industry""",
    "urban": """SELECT s_suppkey AS urban_id, (s_suppkey*7919%60000)/1000e0 AS ux, (s_suppkey*104729%50000)/1000e0 AS uy,
        1.5e0 + (s_suppkey%7)/7e0 AS ua FROM supplier""",
    "pca": """SELECT cast(c_nationkey%3*8 AS int) AS town_village, c_nationkey AS ward, CASE WHEN c_nationkey%2=0 THEN 'Rural' ELSE 'Urban' END AS tru,
        cast(count(*)*37 AS bigint) AS no_of_households FROM customer GROUP BY c_nationkey""",
    "hl": """SELECT DISTINCT cast(c_nationkey%3*8 AS int) AS town_village, c_nationkey AS ward, 5e0+c_nationkey%3 AS s1, 10e0 AS s2, 15e0 AS s3,
        25e0 AS s4, 20e0-c_nationkey%3 AS s5, 15e0 AS s6, 10e0 AS s7 FROM customer WHERE c_nationkey%4<>3""",
}

# derived building blocks shared by several queries
DERIVED: dict[str, str] = {
    # E1 --------------------------------------------------------------------
    "mass_raw": """SELECT r.sno, r.station_id, r.ts, cast(split_part(r.time,'T',1) AS date) AS date,
        split_part(r.time,'T',2) AS time2, r.pm05, r.pm25, w.hum, {band} AS cf,
        r.pm05*3531.5e0*5.89e-7 AS mass_pm25, r.pm25*3531.5e0*1.21e-4 AS mass_pm10
        FROM readings r JOIN weather w ON cast(split_part(r.time,'T',1) AS date) = w.date""",
    "mass": """SELECT *, mass_pm25*(hum*0.01e0)*cf AS cmass_pm25, mass_pm10*(hum*0.01e0)*cf AS cmass_pm10 FROM mass_raw""",
    # E2 --------------------------------------------------------------------
    "ind_cells": """SELECT i.*, g.gid, g.ix, g.iy FROM industry i JOIN grid g
        ON i.x >= g.ix AND i.x <= g.ix + 1 AND i.y >= g.iy AND i.y <= g.iy + 1""",
    "industry_inv": """SELECT g.gid, coalesce(s.a, 0e0) AS pm10_emiss_s, coalesce(s.b, 0e0) AS pm25_emiss_s,
        coalesce(s.a, 0e0)*365e0/1e6 AS pm10_tpy, coalesce(s.b, 0e0)*365e0/1e6 AS pm25_tpy
        FROM grid g LEFT JOIN (SELECT gid, sum(pm10_emiss) AS a, sum(pm25_emiss) AS b FROM ind_cells GROUP BY gid) s USING (gid)""",
    # E3 / E5 ---------------------------------------------------------------
    "road_clip": """SELECT r.road_id, r.cat, r.gid,
        r.x1 - r.x0 AS dx, r.y1 - r.y0 AS dy,
        CASE WHEN r.x1 = r.x0 THEN 0e0 ELSE least((r.ix - r.x0)/(r.x1 - r.x0), (r.ix + 1 - r.x0)/(r.x1 - r.x0)) END AS ex,
        CASE WHEN r.x1 = r.x0 THEN 1e0 ELSE greatest((r.ix - r.x0)/(r.x1 - r.x0), (r.ix + 1 - r.x0)/(r.x1 - r.x0)) END AS lx,
        CASE WHEN r.y1 = r.y0 THEN 0e0 ELSE least((r.iy - r.y0)/(r.y1 - r.y0), (r.iy + 1 - r.y0)/(r.y1 - r.y0)) END AS ey,
        CASE WHEN r.y1 = r.y0 THEN 1e0 ELSE greatest((r.iy - r.y0)/(r.y1 - r.y0), (r.iy + 1 - r.y0)/(r.y1 - r.y0)) END AS ly,
        (r.x1 = r.x0 AND (r.x0 < r.ix OR r.x0 > r.ix + 1)) AS mx,
        (r.y1 = r.y0 AND (r.y0 < r.iy OR r.y0 > r.iy + 1)) AS my
        FROM (SELECT *, cast(ix*50 + iy + 1 AS int) AS gid FROM (
          SELECT *, unnest(range(greatest(0, cast(floor(least(y0, y1)) AS bigint) - 1), least(49, cast(floor(greatest(y0, y1)) AS bigint)) + 1)) AS iy FROM (
          SELECT *, unnest(range(greatest(0, cast(floor(least(x0, x1)) AS bigint) - 1), least(59, cast(floor(greatest(x0, x1)) AS bigint)) + 1)) AS ix FROM roads))) r""",
    "road_pieces": """SELECT road_id, cat, gid,
        (least(1e0, lx, ly) - greatest(0e0, ex, ey)) * sqrt(dx*dx + dy*dy) * 100e0 AS length
        FROM road_clip WHERE NOT mx AND NOT my AND greatest(0e0, ex, ey) <= least(1e0, lx, ly)""",
    "road_cells": "SELECT road_id, cat, gid, sum(length) AS length FROM road_pieces GROUP BY road_id, cat, gid",
    "road_lpc": "SELECT gid, sum({lpc}) AS lpc FROM road_cells GROUP BY gid",
    "road_inv": """SELECT g.gid, coalesce(l.lpc*{r25}, 0e0) AS pm25, coalesce(l.lpc*{r10}, 0e0) AS pm10,
        coalesce(l.lpc*{r10}*365e0/1e6, 0e0) AS pm10_tpy, coalesce(l.lpc*{r25}*365e0/1e6, 0e0) AS pm25_tpy
        FROM grid g LEFT JOIN road_lpc l USING (gid)""",
    "dust_inv": """SELECT g.gid, coalesce(l.lpc*{d25}, 0e0) AS pm25, coalesce(l.lpc*{d10}, 0e0) AS pm10,
        coalesce(l.lpc*{d10}/1e6, 0e0) AS pm10_tpy, coalesce(l.lpc*{d25}/1e6, 0e0) AS pm25_tpy
        FROM grid g LEFT JOIN road_lpc l USING (gid)""",
    # E4 --------------------------------------------------------------------
    "stop_dict": """SELECT replace(stop, ' ', '') AS stop_key, arg_max(x, stop_id) AS x, arg_max(y, stop_id) AS y
        FROM stops GROUP BY 1""",
    "resolved": """SELECT rs.route, rs.total_sing, rs.pos, rs.stop_key, d.x, d.y, d.stop_key IS NOT NULL AS resolved
        FROM route_stops rs LEFT JOIN stop_dict d ON rs.stop_key = d.stop_key""",
    "route_segs": """SELECT * FROM (SELECT route, total_sing, x AS x0, y AS y0, lead(x) OVER w AS x1, lead(y) OVER w AS y1
        FROM resolved WHERE resolved WINDOW w AS (PARTITION BY route ORDER BY pos)) WHERE x1 IS NOT NULL""",
    "route_cell_pairs": """SELECT DISTINCT s.route, s.total_sing, g.gid FROM route_segs s JOIN grid g
        ON g.ix BETWEEN floor(least(s.x0, s.x1)) - 1 AND floor(greatest(s.x0, s.x1))
       AND g.iy BETWEEN floor(least(s.y0, s.y1)) - 1 AND floor(greatest(s.y0, s.y1))
        WHERE NOT (s.x1 = s.x0 AND (s.x0 < g.ix OR s.x0 > g.ix + 1))
          AND NOT (s.y1 = s.y0 AND (s.y0 < g.iy OR s.y0 > g.iy + 1))
          AND greatest(0e0,
                CASE WHEN s.x1 = s.x0 THEN 0e0 ELSE least((g.ix - s.x0)/(s.x1 - s.x0), (g.ix + 1 - s.x0)/(s.x1 - s.x0)) END,
                CASE WHEN s.y1 = s.y0 THEN 0e0 ELSE least((g.iy - s.y0)/(s.y1 - s.y0), (g.iy + 1 - s.y0)/(s.y1 - s.y0)) END)
           <= least(1e0,
                CASE WHEN s.x1 = s.x0 THEN 1e0 ELSE greatest((g.ix - s.x0)/(s.x1 - s.x0), (g.ix + 1 - s.x0)/(s.x1 - s.x0)) END,
                CASE WHEN s.y1 = s.y0 THEN 1e0 ELSE greatest((g.iy - s.y0)/(s.y1 - s.y0), (g.iy + 1 - s.y0)/(s.y1 - s.y0)) END)""",
    "bus_inv": """SELECT g.gid, cast(coalesce(t.ts, 0) AS bigint) AS ts,
        coalesce(t.ts*1.075e0*365e0*0.814e0/1e6, 0e0) AS pm25_tpy, coalesce(t.ts*1.075e0*365e0*0.278e0/1e6, 0e0) AS pm10_tpy
        FROM grid g LEFT JOIN (SELECT gid, sum(total_sing) AS ts FROM route_cell_pairs GROUP BY gid) t USING (gid)""",
    # E6 --------------------------------------------------------------------
    "centres": "SELECT gid, 0e0 + (ix + 0.5e0)*1e0 AS x, 0e0 + (iy + 0.5e0)*1e0 AS y FROM grid",
    "centre_wards": """SELECT c.gid, w.wrd FROM centres c JOIN wards w ON c.x > w.x0 AND c.x < w.x1 AND c.y > w.y0 AND c.y < w.y1""",
    "res_points": """SELECT cw.gid, cw.wrd, n.grid_count, c.* FROM centre_wards cw
        JOIN (SELECT wrd, count(*) AS grid_count FROM centre_wards GROUP BY wrd) n USING (wrd)
        JOIN census c ON cw.wrd = c.tvw""",
    "res_noh": "SELECT *, round_even(no_of_households/grid_count, 0) AS noh FROM res_points",
    "res_nohs": """SELECT *, noh*(s1/100e0) AS nohs1, noh*(s2/100e0) AS nohs2, noh*(s3/100e0) AS nohs3, noh*(s4/100e0) AS nohs4,
        noh*(s5/100e0) AS nohs5, noh*(s6/100e0) AS nohs6, noh*(s7/100e0) AS nohs7 FROM res_noh""",
    "res_use": "SELECT gid, {uses} FROM res_nohs",
    "res_pm": "SELECT gid, {pm25} AS pm25, {pm10} AS pm10 FROM res_use",
    "res_inv": """SELECT g.gid, coalesce(p.pm25, 0e0) AS pm25, coalesce(p.pm10, 0e0) AS pm10,
        coalesce(p.pm10*12.16e0/1e6, 0e0) AS pm10_tpy, coalesce(p.pm25*12.16e0/1e6, 0e0) AS pm25_tpy
        FROM grid g LEFT JOIN (SELECT gid, sum(pm25) AS pm25, sum(pm10) AS pm10 FROM res_pm GROUP BY gid) p USING (gid)""",
    # E14 -------------------------------------------------------------------
    "total_inv": """SELECT gid, sum(pm10_tpy) AS pm10_tot, sum(pm25_tpy) AS pm25_tot FROM (
        SELECT gid, pm10_tpy, pm25_tpy FROM industry_inv UNION ALL SELECT gid, pm10_tpy, pm25_tpy FROM road_inv
        UNION ALL SELECT gid, pm10_tpy, pm25_tpy FROM bus_inv UNION ALL SELECT gid, pm10_tpy, pm25_tpy FROM dust_inv
        UNION ALL SELECT gid, pm10_tpy, pm25_tpy FROM res_inv) GROUP BY gid""",
    # E7 / E8 ---------------------------------------------------------------
    "field": """SELECT species, month, cast(date_diff('day', DATE '1970-01-01', make_date(2010, month, 1)) AS int) AS time_days,
        lat_idx, lon_idx, sum(emi) AS emi_pm FROM sector_fields GROUP BY species, month, lat_idx, lon_idx""",
    "region_blocks": """SELECT cast(floor(g.ix/10) AS int) AS bx, cast(floor(g.iy/10) AS int) AS bky,
        sum(t.pm10_tot*907.185e0/3.15569e7/1e6) AS flux_pm10, sum(t.pm25_tot*907.185e0/3.15569e7/1e6) AS flux_pm25,
        avg(10e0 + (g.iy + 0.5e0)*0.01e0) AS lat, avg(76e0 + (g.ix + 0.5e0)*0.01e0) AS lon
        FROM total_inv t JOIN grid g USING (gid) GROUP BY 1, 2""",
    "region_placed": """SELECT b.*,
        (SELECT a.lat_idx FROM lat_axis a ORDER BY abs(a.lat - b.lat), a.lat_idx DESC LIMIT 1) AS lat_idx,
        (SELECT o.lon_idx FROM lon_axis o ORDER BY abs(o.lon - b.lon), o.lon_idx DESC LIMIT 1) AS lon_idx
        FROM region_blocks b""",
    "region_long": """SELECT lat_idx, lon_idx, 'A' AS species, flux_pm10 AS flux FROM region_placed
        UNION ALL SELECT lat_idx, lon_idx, 'N' AS species, flux_pm25 AS flux FROM region_placed""",
    # E9 --------------------------------------------------------------------
    "pairs": """SELECT o.time, cast(o.time AS date) AS day, o.value AS obs, m.value AS mod
        FROM observations o JOIN observations m ON o.time = m.time
        WHERE o.property = 'view' AND m.property = 'click' AND o.value IS NOT NULL AND m.value IS NOT NULL""",
}


def Q(expr: str, bits: int) -> str:
    """SQL of ``numeric.quantize``: nearest multiple of 2**-bits, ties to even."""
    scale = f"{2 ** bits}e0"
    return f"(round_even(({expr})*{scale}, 0)/{scale})"


def _num(v: float) -> str:
    """A double literal DuckDB reads as DOUBLE (not DECIMAL)."""
    s = repr(float(v))
    return s if ("e" in s or "E" in s) else s + "e0"


def _band(col: str) -> str:
    whens = " ".join(
        f"WHEN {col} >= {lo} AND {col} <= {hi} THEN {_num(f)}" for lo, hi, f in factors.HUMIDITY_BANDS
    )
    return f"CASE {whens} END"


def _lpc(length: str = "length", cat: str = "cat") -> str:
    whens = " ".join(
        f"WHEN {cat} = '{c}' THEN {length}/{_num(t)}*{_num(w)}" for c, (t, w) in factors.ROAD_WEIGHTS.items()
    )
    return f"CASE {whens} ELSE 0e0 END"


def _fuel(rr: float, ru: float) -> str:
    r = f"(CASE WHEN tru = 'Rural' THEN {_num(rr)} ELSE {_num(ru)} END)"
    terms = [f"(noh*(nohs1/100e0))*{r}"]
    for k in factors.HOUSEHOLD_SIZE_WEIGHTS[1:]:
        terms.append(f"(noh*(nohs{k}/100e0))*{r}*{_num(k)}")
    terms.append(f"(noh*(nohs1/100e0))*{r}*{_num(factors.HOUSEHOLD_LAST_WEIGHT)}")
    return "(" + " + ".join(terms) + ")"


def _pm(pol: str) -> str:
    return " + ".join(f"use_{f}*{_num(w)}" for f, w in factors.FUEL_FACTORS[pol].items())


def _render(body: str) -> str:
    return body.format(
        band=_band("w.hum"),
        lpc=_lpc(),
        r25=_num(factors.ROAD_FACTORS["pm25"]),
        r10=_num(factors.ROAD_FACTORS["pm10"]),
        d25=_num(factors.DUST_FACTORS["pm25"]),
        d10=_num(factors.DUST_FACTORS["pm10"]),
        uses=", ".join(f"{_fuel(rr, ru)} AS use_{f}" for f, (rr, ru) in factors.FUEL_RATES.items()),
        pm25=_pm("pm25"),
        pm10=_pm("pm10"),
    )


# computed once, however often a statement reads them
_ONCE = {"road_cells", "resolved", "total_inv", "centre_wards", "pairs"}

# dependency order of every CTE
_ORDER = list(FIXTURES) + list(DERIVED)
_DEPS = {
    "footprints": ["industry"], "sites": ["industry"],
    "mass_raw": ["readings", "weather"], "mass": ["mass_raw"],
    "ind_cells": ["industry", "grid"], "industry_inv": ["ind_cells", "grid"],
    "road_clip": ["roads"], "road_pieces": ["road_clip"], "road_cells": ["road_pieces"],
    "road_lpc": ["road_cells"], "road_inv": ["road_lpc", "grid"], "dust_inv": ["road_lpc", "grid"],
    "stop_dict": ["stops"], "resolved": ["route_stops", "stop_dict"], "route_segs": ["resolved"],
    "route_cell_pairs": ["route_segs", "grid"], "bus_inv": ["route_cell_pairs", "grid"],
    "centres": ["grid"], "centre_wards": ["centres", "wards"], "res_points": ["centre_wards", "census"],
    "res_noh": ["res_points"], "res_nohs": ["res_noh"], "res_use": ["res_nohs"], "res_pm": ["res_use"],
    "res_inv": ["res_pm", "grid"],
    "total_inv": ["industry_inv", "road_inv", "bus_inv", "dust_inv", "res_inv"],
    "field": ["sector_fields"], "region_blocks": ["total_inv", "grid"],
    "region_placed": ["region_blocks", "lat_axis", "lon_axis"], "region_long": ["region_placed"],
    "pairs": ["observations"],
}


def _closure(names: list[str]) -> list[str]:
    need: set[str] = set()

    def visit(n: str) -> None:
        if n in need:
            return
        need.add(n)
        for d in _DEPS.get(n, []):
            visit(d)

    for n in names:
        visit(n)
    return [n for n in _ORDER if n in need]


def with_ctes(uses: list[str], final: str) -> str:
    bodies = {**FIXTURES, **DERIVED}
    ctes = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in _ONCE else ''}({_render(bodies[n])})" for n in _closure(uses))
    return f"WITH {ctes}\n{final}"


# ---------------------------------------------------------------------------
# per-query SQL
# ---------------------------------------------------------------------------

_MASS_OUT = """SELECT sno, station_id, strftime(date, '%Y-%m-%d') AS date, time2, pm05, pm25, hum, cf,
    mass_pm25, mass_pm10, cmass_pm25, cmass_pm10 FROM mass"""

_LATEST = """SELECT station_id, sno, text, split_part(text, ',', 2) AS field1, split_part(text, ',', 3) AS field2 FROM (
    SELECT station_id, sno, concat(time, ',', cast(pm05 AS string), ',', cast(pm25 AS string)) AS text,
           row_number() OVER (PARTITION BY station_id ORDER BY sno DESC) AS rn FROM readings) WHERE rn = 1"""

_STAT_COLS = ["fac2", "mb", "mge", "nmb", "nmge", "rmse", "r", "coe", "ioa"]
_STAT = f"""SELECT strftime(day, '%Y-%m-%d') AS day, cast(n AS bigint) AS n,
    {", ".join(Q(c, 23) + " AS " + c for c in _STAT_COLS)}
  FROM (SELECT day, n, fac2, mb, mge, sd/nullif(so, 0) AS nmb, sad/nullif(so, 0) AS nmge, sqrt(msd) AS rmse, r,
          1e0 - sad/nullif(b, 0) AS coe,
          CASE WHEN sad <= 2e0*b THEN 1e0 - sad/nullif(2e0*b, 0) ELSE 2e0*b/nullif(sad, 0) - 1e0 END AS ioa
  FROM (SELECT p.day, count(*) AS n,
      sum(CASE WHEN obs <> 0 AND mod/obs >= 0.5e0 AND mod/obs <= 2e0 THEN 1 ELSE 0 END)
        / nullif(count(CASE WHEN obs <> 0 THEN 1 END), 0) AS fac2,
      avg(mod - obs) AS mb, avg(abs(mod - obs)) AS mge, sum(mod - obs) AS sd, sum(abs(mod - obs)) AS sad,
      sum(obs) AS so, avg((mod - obs)*(mod - obs)) AS msd, corr(mod, obs) AS r,
      sum(abs(obs - m.mo)) AS b
    FROM pairs p JOIN (SELECT day, avg(obs) AS mo FROM pairs GROUP BY day) m USING (day) GROUP BY p.day))"""


def _inv_cols(src: str, cols: dict[str, int]) -> str:
    return ", ".join(f"{Q(c, b)} AS {c}" for c, b in cols.items())


_INV = {"pm10_emiss_s": 16, "pm25_emiss_s": 16, "pm10_tpy": 27, "pm25_tpy": 27}
_BAND_NULL = _band("w.hum")
_WEIGHTS = ", ".join(f"('{c}', {_num(w)})" for c, (_, w) in factors.ROAD_WEIGHTS.items())

QUERIES_SQL: dict[str, tuple[list[str], str]] = {
    "count_to_mass": (["mass"], _MASS_OUT),
    "humidity_band_rejects": (["readings", "weather"], f"""SELECT reason, strftime(date, '%Y-%m-%d') AS date, count(*) AS n FROM (
        SELECT cast(split_part(r.time,'T',1) AS date) AS date,
               CASE WHEN w.hum IS NULL THEN 'no_weather' WHEN ({_BAND_NULL}) IS NULL THEN 'no_band' END AS reason
        FROM readings r LEFT JOIN weather w ON cast(split_part(r.time,'T',1) AS date) = w.date)
        WHERE reason IS NOT NULL GROUP BY reason, date"""),
    "grid_cells": (["grid", "industry"], """SELECT g.gid, g.ix, g.iy, coalesce(c.n, 0) AS n_points FROM grid g LEFT JOIN (
        SELECT cast(floor(x)*50 + floor(y) + 1 AS int) AS gid, count(*) AS n FROM industry
        WHERE x >= 0 AND x < 60 AND y >= 0 AND y < 50 GROUP BY 1) c USING (gid)"""),
    "upscale_block_sum": (["industry_inv", "grid"], f"""SELECT block_x, block_y, {Q("a", 23)} AS pm10_tpy, {Q("b", 23)} AS pm25_tpy,
        {Q("lat", 24)} AS lat, {Q("lon", 24)} AS lon, bgid FROM (
        SELECT cast(floor(g.ix/10) AS int) AS block_x, cast(floor(g.iy/10) AS int) AS block_y,
          sum(pm10_tpy) AS a, sum(pm25_tpy) AS b,
          avg(10e0 + (g.iy + 0.5e0)*0.01e0) AS lat, avg(76e0 + (g.ix + 0.5e0)*0.01e0) AS lon,
          cast(floor(g.ix/10)*5 + floor(g.iy/10) + 1 AS int) AS bgid
        FROM industry_inv i JOIN grid g USING (gid) GROUP BY 1, 2, 7)"""),
    "unit_convert": (["industry_inv"], f"""SELECT gid, {Q("pm10_tpy*907.185e0/3.15569e7/1e6", 60)} AS flux_pm10,
        {Q("pm25_tpy*907.185e0/3.15569e7/1e6", 60)} AS flux_pm25 FROM industry_inv"""),
    "industry_inventory": (["industry_inv"], f"SELECT gid, {_inv_cols('industry_inv', _INV)} FROM industry_inv"),
    "keep_last_by_cell": (["ind_cells"], """SELECT gid, ind_id, pm10_emiss, pm25_emiss FROM (
        SELECT *, row_number() OVER (PARTITION BY gid ORDER BY ind_id DESC) AS rn FROM ind_cells) WHERE rn = 1"""),
    "sum_with_representative": (["ind_cells"], f"""SELECT s.gid, s.n, {Q("s.a", 16)} AS pm10_sum, {Q("s.b", 16)} AS pm25_sum,
        c.ind_id, c.x, c.y FROM (SELECT gid, count(*) AS n, sum(pm10_emiss) AS a, sum(pm25_emiss) AS b, max(ind_id) AS last_id
        FROM ind_cells GROUP BY gid) s JOIN ind_cells c ON c.gid = s.gid AND c.ind_id = s.last_id"""),
    "industry_overlay_area": (["footprints", "grid"], f"""SELECT gid, {_inv_cols('x', _INV)} FROM (
        SELECT g.gid, coalesce(a, 0e0) AS pm10_emiss_s, coalesce(b, 0e0) AS pm25_emiss_s,
          coalesce(a, 0e0)*365e0/1e6 AS pm10_tpy, coalesce(b, 0e0)*365e0/1e6 AS pm25_tpy FROM grid g LEFT JOIN (
          SELECT gid, sum(pm10_emiss*(cell_area/poly_area)) AS a, sum(pm25_emiss*(cell_area/poly_area)) AS b FROM (
            SELECT f.*, g2.gid,
              (least(f.fx1, g2.ix + 1) - greatest(f.fx0, g2.ix)) * (least(f.fy1, g2.iy + 1) - greatest(f.fy0, g2.iy)) AS cell_area,
              (f.fx1 - f.fx0)*(f.fy1 - f.fy0) AS poly_area
            FROM footprints f JOIN grid g2 ON g2.ix < f.fx1 AND g2.ix + 1 > f.fx0 AND g2.iy < f.fy1 AND g2.iy + 1 > f.fy0)
          GROUP BY gid) s USING (gid))"""),
    "road_overlay_length": (["road_cells"], f"SELECT road_id, cat, gid, {Q('length', 20)} AS length FROM road_cells"),
    "category_share": (["road_cells"], f"""SELECT road_id, cat, gid, {Q('length', 20)} AS length,
        {Q('CASE WHEN t.total IS NOT NULL THEN length/t.total*t.w ELSE 0e0 END', 40)} AS lpc
        FROM road_cells LEFT JOIN (SELECT c.cat AS tcat, sum(length) AS total, any_value(w.w) AS w FROM road_cells c
           JOIN (VALUES {_WEIGHTS}) AS w(cat, w) ON c.cat = w.cat GROUP BY c.cat) t ON road_cells.cat = t.tcat"""),
    "road_inventory": (["road_inv"], f"""SELECT gid, {Q('pm25', 3)} AS pm25, {Q('pm10', 3)} AS pm10,
        {Q('pm10_tpy', 14)} AS pm10_tpy, {Q('pm25_tpy', 14)} AS pm25_tpy FROM road_inv"""),
    "windblown_inventory": (["dust_inv"], f"""SELECT gid, {Q('pm25', 0)} AS pm25, {Q('pm10', 0)} AS pm10,
        {Q('pm10_tpy', 14)} AS pm10_tpy, {Q('pm25_tpy', 14)} AS pm25_tpy FROM dust_inv"""),
    "points_in_polygons": (["industry", "wards"], """SELECT i.ind_id, w.wrd FROM industry i JOIN wards w
        ON i.x > w.x0 AND i.x < w.x1 AND i.y > w.y0 AND i.y < w.y1"""),
    "polygon_centroid": (["footprints"], f"""SELECT ind_id, {Q('(fx0 + fx1)/2e0', 24)} AS cx, {Q('(fy0 + fy1)/2e0', 24)} AS cy,
        {Q('(fx1 - fx0)*(fy1 - fy0)', 27)} AS area FROM footprints"""),
    "resolve_stops": (["resolved"], "SELECT route, pos, stop_key, x, y, resolved FROM resolved"),
    "route_cells": (["route_cell_pairs"], "SELECT route, gid FROM route_cell_pairs"),
    "bus_inventory": (["bus_inv"], "SELECT gid, ts, pm25_tpy, pm10_tpy FROM bus_inv"),
    "census_join": (["wards", "census"], """SELECT w.wrd, w.area_name, cast(c.tvw AS double) AS tvw, c.tru, cast(c.no_of_households AS double) AS no_of_households,
        c.s1, c.s2, c.s3, c.s4, c.s5, c.s6, c.s7 FROM wards w LEFT JOIN census c ON w.wrd = c.tvw"""),
    "equal_share": (["industry", "wards"], """SELECT ind_id, wrd, grid_count, 1e0/grid_count AS wrd_prop FROM (
        SELECT i.ind_id, w.wrd, count(*) OVER (PARTITION BY w.wrd) AS grid_count FROM industry i JOIN wards w
        ON i.x > w.x0 AND i.x < w.x1 AND i.y > w.y0 AND i.y < w.y1)"""),
    "residential_inventory": (["res_inv"], f"""SELECT gid, {Q('pm25', 13)} AS pm25, {Q('pm10', 13)} AS pm10,
        {Q('pm10_tpy', 28)} AS pm10_tpy, {Q('pm25_tpy', 28)} AS pm25_tpy FROM res_inv"""),
    "total_inventory": (["total_inv"], f"SELECT gid, {Q('pm10_tot', 14)} AS pm10_tot, {Q('pm25_tot', 14)} AS pm25_tot FROM total_inv"),
    "sector_monthly_total": (["field"], f"""SELECT species, month, time_days,
        strftime(DATE '1970-01-01' + time_days, '%Y-%m-%d') AS time, lat_idx, lon_idx, {Q('emi_pm', 50)} AS emi_pm FROM field"""),
    "time_axis": (["sector_fields"], """SELECT month, time_days, strftime(DATE '1970-01-01' + time_days, '%Y-%m-%d') AS time FROM (
        SELECT DISTINCT month, cast(date_diff('day', DATE '1970-01-01', make_date(2010, month, 1)) AS int) AS time_days
        FROM sector_fields)"""),
    "nearest_axis_index": (["industry", "lat_axis", "lon_axis"], """SELECT a.ind_id, a.lat_idx, o.lon_idx FROM
        (SELECT ind_id, lat_idx FROM (SELECT i.ind_id, l.lat_idx, row_number() OVER (PARTITION BY i.ind_id
           ORDER BY abs(l.lat - (10e0 + i.y*0.01e0)), l.lat_idx DESC) AS rn FROM industry i, lat_axis l) WHERE rn = 1) a
        JOIN (SELECT ind_id, lon_idx FROM (SELECT i.ind_id, l.lon_idx, row_number() OVER (PARTITION BY i.ind_id
           ORDER BY abs(l.lon - (76e0 + i.x*0.01e0)), l.lon_idx DESC) AS rn FROM industry i, lon_axis l) WHERE rn = 1) o
        USING (ind_id)"""),
    "merge_region_into_field": (["field", "region_long"], f"""SELECT species, month, lat_idx, lon_idx,
        {Q('emi_pm + region_add', 60)} AS emi_pm, {Q('region_add', 60)} AS region_add FROM (
        SELECT coalesce(f.species, r.species) AS species, coalesce(f.month, r.month) AS month, coalesce(f.lat_idx, r.lat_idx) AS lat_idx,
          coalesce(f.lon_idx, r.lon_idx) AS lon_idx, coalesce(f.emi_pm, 0e0) AS emi_pm, coalesce(r.add, 0e0) AS region_add
        FROM field f FULL JOIN (SELECT species, cast(m AS int) AS month, lat_idx, lon_idx, sum(flux) AS add
          FROM region_long, range(1, 13) AS t(m) GROUP BY 1, 2, 3, 4) r
        ON f.species = r.species AND f.month = r.month AND f.lat_idx = r.lat_idx AND f.lon_idx = r.lon_idx)"""),
    "observation_window": (["observations"], f"""SELECT strftime(time, '%Y-%m-%d %H:%M:%S') AS time, property, {Q('value', 23)} AS value FROM observations
        WHERE property IN ('view', 'click') AND time >= TIMESTAMP '2024-01-14 00:00:00' AND time <= TIMESTAMP '2024-01-19 00:00:00'"""),
    "model_skill": (["pairs"], _STAT),
    "station_documents": (["stations"], """SELECT code_txt AS code, json_object(
        'description', name,
        'location', json_object('geometry', json_object('coordinates',
              [cast(lon AS string), cast(lat AS string), cast(elevation AS string)], 'type', 'Point'),
            'properties', json_object('name', code_txt), 'type', 'Feature'),
        'system', code_txt, 'system_id', code_txt)::VARCHAR AS json
        FROM (SELECT *, CASE WHEN code = floor(code) THEN cast(cast(floor(code) AS bigint) AS string)
                             ELSE cast(code AS string) END AS code_txt FROM stations)"""),
    "missing_inputs": (["input_files"], """SELECT strftime(t, '%Y%m%d_%H%M') AS stamp,
        concat('gfsanl_3_', strftime(t, '%Y%m%d_%H%M'), '_000.grb') AS expected_name FROM (
          SELECT unnest(generate_series(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(s - s % 10800),
                 TIMESTAMP '1970-01-01 00:00:00' + to_seconds(e - e % 10800),
                 INTERVAL 3 HOUR)) AS t FROM (SELECT cast(floor(epoch(min(ts))) AS bigint) AS s,
                 cast(floor(epoch(max(ts))) AS bigint) AS e FROM events))
        WHERE NOT EXISTS (SELECT 1 FROM input_files f WHERE contains(f.path, 'gfsanl')
                          AND contains(f.path, strftime(t, '%Y%m%d_%H%M')))"""),
    "run_report": (["run_log"], """SELECT s.run_id, s.stage, s.n_lines, s.gap/1e6 AS stage_seconds, r.run_seconds,
        r.last_stage, contains(r.last_stage, 'Successful completion') AS success FROM (
          SELECT run_id, stage, count(*) AS n_lines, sum(coalesce(nxt - us, 0)) AS gap FROM (
            SELECT run_id, stage, epoch_us(ts) AS us,
                   lead(epoch_us(ts)) OVER (PARTITION BY run_id ORDER BY epoch_us(ts), line_no) AS nxt FROM run_log)
          GROUP BY run_id, stage) s
        JOIN (SELECT run_id, (max(epoch_us(ts)) - min(epoch_us(ts)))/1e6 AS run_seconds,
                     max(CASE WHEN rn = 1 THEN stage END) AS last_stage FROM (
                SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY epoch_us(ts) DESC, line_no DESC) AS rn FROM run_log)
              GROUP BY run_id) r USING (run_id)"""),
    "latest_reading": (["readings"], _LATEST),
    "stream_count_to_mass": (["mass"], _MASS_OUT),
    "stream_latest": (["readings"], _LATEST),
    "stream_hourly_mass": (["mass"], f"""SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, station_id, n, {Q('a', 17)} AS mean_cmass_pm25,
        {Q('b', 17)} AS mean_cmass_pm10 FROM (
          SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, station_id, count(*) AS n,
                 avg(cmass_pm25) AS a, avg(cmass_pm10) AS b FROM mass GROUP BY 1, 2)
        WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM mass) - INTERVAL 2 HOUR"""),
}


def oracle_sql() -> dict[str, str]:
    from cellflux import catalog_extra, catalog_joins

    return {name: with_ctes(uses, final) for name, (uses, final) in QUERIES_SQL.items()} | catalog_extra.SQL | catalog_joins.SQL
