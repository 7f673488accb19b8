"""DuckDB SQL for the queries, written from the definitions rather than from the
Spark plans: neighbourhoods are joins on offsets, regions a recursive query."""

from __future__ import annotations

from workload.queries import CUT, KERNEL, MIN_PX, NODATA_BELOW, PATCH, REACH, SWAPPED_AFFINE

PX = """px AS MATERIALIZED (
  SELECT CAST(vec_id // 100 AS INT) AS scene_id,
         CAST((vec_id % 100) // 10 * 8 + pos // 8 AS INT) AS r,
         CAST(vec_id % 10 * 8 + pos % 8 AS INT) AS c,
         least(255, greatest(0, CAST(floor((CAST(v AS DOUBLE) + 0.5) * 255) AS INT))) AS dn,
         CAST(label >= 5 AS INT) AS truth,
         CAST(vec_id % 25 AS INT) AS zone_id
  FROM (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)
)"""

CLS = f"cls AS MATERIALIZED (SELECT *, CAST(dn >= {CUT} AS INT) AS cls FROM px)"
#: Each classified cell with its last classified state before.
STEPS = """steps AS (SELECT * FROM (SELECT *, lag(cls) OVER cell AS was, lag(scene_id) OVER cell AS was_scene FROM cls
  WHERE cls IS NOT NULL WINDOW cell AS (PARTITION BY r, c ORDER BY scene_id)) WHERE was IS NOT NULL)"""
MASK = "mask AS MATERIALIZED (SELECT scene_id, r, c FROM cls WHERE cls = 1)"

OBS = """obs AS MATERIALIZED (
  SELECT CAST(l_orderkey % 128 AS INT) AS r, CAST(l_partkey % 128 AS INT) AS c,
         CAST(l_quantity * 5 AS INT) AS dn, l_shipdate AS acq_ts, CAST(l_suppkey % 10 AS INT) AS strip,
         l_orderkey, l_linenumber, l_partkey
  FROM lineitem
)"""

ARRIVALS = """arrivals AS MATERIALIZED (
  SELECT event_id, ts, user_id AS source_id, event_type AS kind,
         CAST(user_id % 25 AS INT) AS zone_id, value, props
  FROM events
)"""

ZONES = """zones AS (
  SELECT n_nationkey AS zone_id, n_name AS zone, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

GCP = """gcp AS (
  SELECT CAST(c_custkey % 5 AS INT) AS scene_id,
         CAST((c_custkey * 7) % 80 AS DOUBLE) AS r, CAST(c_custkey % 80 AS DOUBLE) AS c,
         2.0::DOUBLE * (c_custkey % 80) - 0.5::DOUBLE * ((c_custkey * 7) % 80) + 100 + c_acctbal / 1000 AS x,
         0.5::DOUBLE * (c_custkey % 80) + 2.0::DOUBLE * ((c_custkey * 7) % 80) + 200 - c_acctbal / 1000 AS y
  FROM customer
)"""

COEFFS = "coeffs AS (SELECT DISTINCT scene_id, {} FROM px)".format(
    ", ".join(
        f"{v}::DOUBLE{' + scene_id' if k in ('x0', 'y0') else ''} AS {k}" for k, v in SWAPPED_AFFINE.items()
    )
)

HIST = "hist AS (SELECT scene_id, dn, count(*) AS n FROM px WHERE dn IS NOT NULL GROUP BY ALL)"


def near(radius: int, table: str = "px", value: str = "dn", name: str = "near") -> str:
    """Each cell with each neighbour of the square that exists."""
    return f"""{name} AS MATERIALIZED (
  SELECT p.scene_id, p.r, p.c, p.{value} AS v0, p.dr, p.dc, q.{value} AS v
  FROM (SELECT scene_id, r, c, {value}, CAST(a.i AS INT) AS dr, CAST(b.i AS INT) AS dc,
               CAST(r + a.i AS INT) AS qr, CAST(c + b.i AS INT) AS qc
        FROM {table}, range(-{radius}, {radius + 1}) a(i), range(-{radius}, {radius + 1}) b(i)) p
  JOIN {table} q ON q.scene_id = p.scene_id AND q.r = p.qr AND q.c = p.qc
)"""


def otsu(hist: str = "hist", name: str = "otsu") -> str:
    return f"""{name}_split AS (
  SELECT a.scene_id, a.dn AS t,
         sum(CASE WHEN b.dn <= a.dn THEN b.n ELSE 0 END)::DOUBLE AS n0,
         sum(CASE WHEN b.dn > a.dn THEN b.n ELSE 0 END)::DOUBLE AS n1,
         sum(CASE WHEN b.dn <= a.dn THEN b.n * b.dn ELSE 0 END)::DOUBLE AS s0,
         sum(CASE WHEN b.dn > a.dn THEN b.n * b.dn ELSE 0 END)::DOUBLE AS s1
  FROM {hist} a JOIN {hist} b USING (scene_id) GROUP BY ALL
), {name}_score AS (
  SELECT scene_id, t, CASE WHEN n1 > 0 THEN n0 * n1 * (s0 / n0 - s1 / n1) * (s0 / n0 - s1 / n1) END AS between_var
  FROM {name}_split
), {name}_best AS (
  SELECT scene_id, t FROM {name}_score WHERE between_var IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY scene_id ORDER BY between_var DESC, t) = 1
), {name} AS (
  SELECT s.scene_id, b.t AS threshold FROM (SELECT DISTINCT scene_id FROM {hist}) s LEFT JOIN {name}_best b USING (scene_id)
)"""


def stretch_bounds(table: str, name: str = "bounds") -> str:
    return f"""{name} AS (
  SELECT scene_id, quantile_disc(dn, 0.02) AS lo, quantile_disc(dn, 0.98) AS hi FROM {table} GROUP BY scene_id
)"""


STRETCHED = "least(greatest(dn, lo), hi) - lo"


def stretched(expr: str = STRETCHED) -> str:
    return f"CAST(({expr}) * 255 // greatest(hi - lo, 1) AS INT)"


def components(mask: str, reach: int, name: str = "comp") -> str:
    """Runs of ``mask`` with the region they belong to. ``reach`` is 1 for
    8-connectivity and 0 for 4."""
    return f"""{name}_runs AS MATERIALIZED (
  SELECT scene_id, r, min(c) AS c0, max(c) AS c1, CAST(r AS BIGINT) * 4294967296 + min(c) AS id
  FROM (SELECT *, c - row_number() OVER (PARTITION BY scene_id, r ORDER BY c) AS g FROM {mask}) GROUP BY scene_id, r, g
), {name}_edges AS MATERIALIZED (
  SELECT a.scene_id, a.id AS a, b.id AS b FROM {name}_runs a JOIN {name}_runs b
    ON a.scene_id = b.scene_id AND (b.r = a.r + 1 OR b.r = a.r - 1) AND b.c0 <= a.c1 + {reach} AND b.c1 >= a.c0 - {reach}
), {name}_cc(scene_id, id, label) USING KEY (scene_id, id) AS (
  SELECT scene_id, id, id FROM {name}_runs
  UNION
  SELECT e.scene_id, e.a, min(u.label) FROM {name}_cc u
    JOIN {name}_edges e ON e.scene_id = u.scene_id AND e.b = u.id
    JOIN recurring.{name}_cc k ON k.scene_id = e.scene_id AND k.id = e.a
  WHERE u.label < k.label GROUP BY e.scene_id, e.a
), {name} AS MATERIALIZED (
  SELECT k.*, x.label AS region_id FROM {name}_runs k JOIN {name}_cc x ON x.scene_id = k.scene_id AND x.id = k.id
)"""


def component_cells(name: str = "comp") -> str:
    return f"SELECT scene_id, r, CAST(unnest(range(c0, c1 + 1)) AS INT) AS c, region_id FROM {name}"


def morph(source: str, step: str, name: str) -> str:
    """One erosion (min) or dilation (max) of ``source(scene_id, r, c, cls)``."""
    return near(1, source, "cls", f"{name}_n") + f""", {name} AS MATERIALIZED (
  SELECT scene_id, r, c, {step}(v) AS cls FROM {name}_n GROUP BY scene_id, r, c
)"""


def w(*ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(ctes) + "\n" + select


def focal(radius: int, select: str, table: str = "px", value: str = "dn", *ctes: str) -> str:
    return w(PX, *ctes, near(radius, table, value), select=f"SELECT scene_id, r, c, {select} FROM near GROUP BY scene_id, r, c")


def at(dr: int, dc: int) -> str:
    return f"max(CASE WHEN dr = {dr} AND dc = {dc} THEN v END)"


LBP_RING = [(-1, -1), (-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1), (0, -1)]
GX = f"({at(-1, 1)} + 2 * {at(0, 1)} + {at(1, 1)}) - ({at(-1, -1)} + 2 * {at(0, -1)} + {at(1, -1)})"
GY = f"({at(1, -1)} + 2 * {at(1, 0)} + {at(1, 1)}) - ({at(-1, -1)} + 2 * {at(-1, 0)} + {at(-1, 1)})"


def cell_hash(r: str, c: str) -> str:
    """Two lanes of 31 bits, each multiplied, folded, multiplied and folded again."""

    def lane(kr: int, kc: int, ks: int, again: int) -> str:
        x = f"(({r})::BIGINT * {kr} + ({c})::BIGINT * {kc} + scene_id::BIGINT * {ks}) % 2147483647"
        y = f"(xor({x}, ({x}) >> 15) * {again}) % 2147483647"
        return f"xor({y}, ({y}) >> 13)"

    high, low = lane(73856093, 19349663, 83492791, 1103515245), lane(49979687, 67867967, 32452843, 1664525137)
    return f"({high} * 2147483648 + {low})"


HASH = cell_hash("r", "c")
BLOCK_HASH = cell_hash("r // 16", "c // 16")
DATE = "DATE '1962-06-01' + CAST(scene_id * 90 AS INT)"
CLOSED = "w_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM arrivals)"
MERGED = """CAST(sum(n_px) AS BIGINT) AS n_px, sum(dn_sum) / sum(n_px) AS dn_mean, min(dn_min) AS dn_min,
  max(dn_max) AS dn_max, CAST(sum(n_forest) AS BIGINT) AS n_forest"""
ZSUM = """zsum AS (SELECT scene_id, zone_id, count(dn) AS n_px, sum(dn)::DOUBLE AS dn_sum, min(dn) AS dn_min, max(dn) AS dn_max,
  sum(cls) AS n_forest FROM cls GROUP BY ALL)"""
TWINS = """twins AS MATERIALIZED (
  SELECT scene_id, r, c, dn FROM px UNION ALL
  SELECT CAST(scene_id + 1000 AS INT), CAST(r + scene_id % 5 - 2 AS INT), CAST(c + scene_id % 3 - 1 AS INT),
         CASE WHEN dn >= 40 THEN CAST(dn * 3 // 4 + 20 AS INT) END
  FROM px WHERE r + scene_id % 5 - 2 >= 0 AND c + scene_id % 3 - 1 >= 0
), twin_pairs AS (
  SELECT scene_id AS scene_a, CAST(unnest([scene_id + 1000, scene_id + 1]) AS INT) AS scene_b FROM (SELECT DISTINCT scene_id FROM px)
)"""
#: Correlation of every tile with the other scene at every shift, cell by cell.
SHIFTS = f"""tried AS MATERIALIZED (
  SELECT p.scene_a, p.scene_b, CAST(a.r // {PATCH} AS INT) AS tile_r, CAST(a.c // {PATCH} AS INT) AS tile_c,
         CAST(y.i AS INT) AS dr, CAST(x.i AS INT) AS dc, count(*) AS n, sum(a.dn) AS sa, sum(b.dn) AS sb,
         sum(a.dn * a.dn) AS saa, sum(b.dn * b.dn) AS sbb, sum(a.dn * b.dn) AS sab
  FROM twin_pairs p JOIN twins a ON a.scene_id = p.scene_a, range(-{REACH}, {REACH + 1}) y(i), range(-{REACH}, {REACH + 1}) x(i), twins b
  WHERE b.scene_id = p.scene_b AND b.r = a.r + y.i AND b.c = a.c + x.i AND a.dn IS NOT NULL AND b.dn IS NOT NULL
  GROUP BY ALL
), valid AS (SELECT scene_id AS scene_a, r // {PATCH} AS tile_r, c // {PATCH} AS tile_c, count(dn) AS cells FROM twins GROUP BY ALL
), scored AS (
  SELECT t.*, (n * sab - sa * sb)::DOUBLE / sqrt((n * saa - sa * sa)::DOUBLE * (n * sbb - sb * sb)::DOUBLE) AS score
  FROM tried t JOIN valid USING (scene_a, tile_r, tile_c) WHERE 2 * n >= cells AND n * saa > sa * sa AND n * sbb > sb * sb
), tile_best AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY scene_a, scene_b, tile_r, tile_c ORDER BY score DESC, abs(dr) + abs(dc), dr, dc) = 1
)"""
UNEVEN = """uneven AS MATERIALIZED (
  SELECT * REPLACE (CASE WHEN (r + c + strip) % 7 > 0
    THEN CAST(((r * 37 + c * 53) % 160) * (100 + strip * 4) // 100 + strip * 3 + 5 AS INT) END AS dn) FROM obs)"""


def strip_balance(obs: str) -> str:
    """Gain and offset per strip: the dense normal equations, solved by conjugate gradients on lists."""
    return f"""part AS MATERIALIZED (SELECT r, c, strip, avg(dn) AS x FROM {obs} WHERE dn IS NOT NULL GROUP BY ALL),
seams AS MATERIALIZED (
  SELECT a.strip AS i, b.strip AS j, count(*) AS n, sum(a.x) AS si, sum(b.x) AS sj, sum(a.x * a.x) AS sii, sum(a.x * b.x) AS sij
  FROM part a JOIN part b ON a.r = b.r AND a.c = b.c AND a.strip <> b.strip GROUP BY ALL),
own AS MATERIALIZED (
  SELECT i, 2 * (row_number() OVER (ORDER BY i) - 1) AS k, CAST(sum(n) AS BIGINT) AS n, count(*) AS n_seams, sum(si) AS si, sum(sii) AS sii
  FROM seams GROUP BY i),
entries AS (
  SELECT k AS ri, k AS ci, 1.01::DOUBLE * sii AS v FROM own UNION ALL SELECT k, k + 1, si FROM own
  UNION ALL SELECT k + 1, k, si FROM own UNION ALL SELECT k + 1, k + 1, 1.01::DOUBLE * n FROM own
  UNION ALL SELECT a.k, b.k, -sij FROM seams s JOIN own a ON a.i = s.i JOIN own b ON b.i = s.j
  UNION ALL SELECT a.k, b.k + 1, -s.si FROM seams s JOIN own a ON a.i = s.i JOIN own b ON b.i = s.j
  UNION ALL SELECT a.k + 1, b.k, -s.sj FROM seams s JOIN own a ON a.i = s.i JOIN own b ON b.i = s.j
  UNION ALL SELECT a.k + 1, b.k + 1, -s.n FROM seams s JOIN own a ON a.i = s.i JOIN own b ON b.i = s.j),
numbers AS (SELECT k AS u FROM own UNION ALL SELECT k + 1 FROM own),
lines AS (
  SELECT x.u AS ri, list(coalesce(e.v, 0.0)::DOUBLE ORDER BY y.u) AS line
  FROM numbers x CROSS JOIN numbers y LEFT JOIN entries e ON e.ri = x.u AND e.ci = y.u GROUP BY x.u),
matrix AS MATERIALIZED (SELECT list(line ORDER BY ri) AS a, list(line[ri + 1] ORDER BY ri) AS d FROM lines),
right_side AS (SELECT flatten(list([0.01::DOUBLE * sii, 0.0::DOUBLE] ORDER BY k)) AS b FROM own),
rounds(t, x, res, p, z) AS (
  SELECT 0, list_transform(b, lambda v: 0.0::DOUBLE), b, list_transform(list_zip(b, d), lambda v: v[1] / v[2]),
         list_dot_product(b, list_transform(list_zip(b, d), lambda v: v[1] / v[2])) FROM right_side, matrix
  UNION ALL
  SELECT t + 1, x2, res2, list_transform(list_zip(z2, p), lambda v: v[1] + zz / z * v[2]), zz
  FROM (SELECT *, list_dot_product(res2, z2) AS zz
    FROM (SELECT *, list_transform(list_zip(res2, d), lambda v: v[1] / v[2]) AS z2
      FROM (SELECT t, p, z, d, list_transform(list_zip(x, p), lambda v: v[1] + step * v[2]) AS x2,
                   list_transform(list_zip(res, q), lambda v: v[1] - step * v[2]) AS res2
        FROM (SELECT *, z / list_dot_product(p, q) AS step
          FROM (SELECT *, list_transform(a, lambda line: list_dot_product(line, p)) AS q
                FROM rounds, matrix WHERE t < 300 AND z > 1e-28 * (SELECT list_dot_product(b, b) FROM right_side)))))) ),
solution AS (SELECT x FROM rounds ORDER BY t DESC LIMIT 1),
strips AS MATERIALIZED (SELECT i AS strip, x[k + 1] AS gain, x[k + 2] AS "offset", n AS n_cells, n_seams FROM own, solution)"""


CONF = "conf AS (SELECT scene_id, cls, truth, count(*) AS n FROM cls GROUP BY ALL)"
CELLS = "scene_id, r, c"

ORACLES: dict[str, str] = {
    "sketch_rollup": w(
        PX, select=f"SELECT scene_id, count(*) AS n_px, TRUE AS near_levels, TRUE AS near_quantiles FROM px WHERE dn >= {NODATA_BELOW} GROUP BY scene_id"
    ),
    # rings
    "trace_rings": w(
        PX, CLS, MASK, components("mask", 1), f"cells AS MATERIALIZED ({component_cells()})",
        """sides AS (SELECT a.scene_id, a.region_id, count(*) - count(b.r) AS bare FROM cells a CROSS JOIN (VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) d(i, j)
  LEFT JOIN mask b ON b.scene_id = a.scene_id AND b.r = a.r + d.i AND b.c = a.c + d.j GROUP BY ALL)""",
        "areas AS (SELECT scene_id, region_id, count(*) AS n_px FROM cells GROUP BY ALL)",
        select="""SELECT scene_id, region_id, 1::BIGINT AS n_outer, n_px, CAST(bare AS BIGINT) AS length
FROM areas JOIN sides USING (scene_id, region_id)""",
        recursive=True,
    ),
    "ring_holes": w(
        PX, CLS, MASK, "gaps AS MATERIALIZED (SELECT scene_id, r, c FROM cls WHERE cls = 0)", components("gaps", 0),
        f"parts AS (SELECT scene_id, region_id, bool_or(r IN (0, 79) OR c IN (0, 79)) AS open FROM ({component_cells()}) GROUP BY ALL)",
        select="""SELECT scene_id, CAST(count(CASE WHEN NOT open THEN 1 END) AS BIGINT) AS n_holes
FROM (SELECT DISTINCT scene_id FROM mask) LEFT JOIN parts USING (scene_id) GROUP BY scene_id""",
        recursive=True,
    ),
    "fill_rings_nodata": w(
        PX, f"dark AS MATERIALIZED (SELECT scene_id, r, c FROM px WHERE dn >= {CUT})", components("dark", 0), select=component_cells(), recursive=True
    ),
    # whole lines
    "summed_area": w(
        PX,
        "part AS (SELECT *, sum(dn) OVER (PARTITION BY scene_id, r ORDER BY c) AS s, count(dn) OVER (PARTITION BY scene_id, r ORDER BY c) AS k FROM px)",
        select=f"""SELECT {CELLS}, CAST(coalesce(sum(s) OVER up, 0) AS BIGINT) AS total, CAST(sum(k) OVER up AS BIGINT) AS n FROM part
WINDOW up AS (PARTITION BY scene_id, c ORDER BY r)""",
    ),
    **{
        name: w(
            PX,
            *([f"nod AS (SELECT * REPLACE (CASE WHEN dn >= {NODATA_BELOW} THEN dn END AS dn) FROM px)"] if name.endswith("nodata") else ["nod AS (SELECT * FROM px)"]),
            f"""part AS (SELECT *, sum(dn) OVER a AS s, count(dn) OVER a AS k FROM nod
  WINDOW a AS (PARTITION BY scene_id, r ORDER BY c RANGE BETWEEN {radius} PRECEDING AND {radius} FOLLOWING))""",
            select=f"""SELECT {CELLS}, CAST(coalesce(sum(s) OVER b, 0) AS BIGINT) AS b_sum, CAST(sum(k) OVER b AS BIGINT) AS b_n,
  sum(s) OVER b / nullif(sum(k) OVER b, 0) AS b_mean FROM part
WINDOW b AS (PARTITION BY scene_id, c ORDER BY r RANGE BETWEEN {radius} PRECEDING AND {radius} FOLLOWING)""",
        )
        for name, radius in (("box_mean", 40), ("box_mean_300", 300), ("box_mean_nodata", 40))
    },
    **{
        name: w(
            PX,
            *([f"cls AS MATERIALIZED (SELECT *, CASE WHEN dn >= {NODATA_BELOW} THEN CAST(dn >= {level} AS INT) END AS cls FROM px)"]),
            "marks AS (SELECT scene_id, r, c, cls FROM cls WHERE cls IS NOT NULL)",
            """near AS (SELECT a.scene_id, a.r, a.c, min((a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c)) AS d2
  FROM marks a JOIN marks b ON a.scene_id = b.scene_id AND a.cls <> b.cls GROUP BY ALL)""",
            select="""SELECT scene_id, r, c, cls, CAST(d2 AS BIGINT) AS d2 FROM cls LEFT JOIN near USING (scene_id, r, c)""",
        )
        for name, level in (("distance_transform", 230),)
    },
    # balance of strips
    "seam_balance": w(
        OBS, strip_balance("obs"),
        select="""SELECT strip, round(gain, 6) AS gain, round("offset", 6) AS "offset", n_cells, n_seams, TRUE AS solved FROM strips""",
        recursive=True,
    ),
    "balanced_bias": w(
        OBS, UNEVEN, strip_balance("uneven"),
        """even AS (SELECT u.r, u.c, u.strip, CAST(greatest(0, least(255, round(gain * dn + "offset"))) AS INT) AS dn
  FROM uneven u JOIN strips USING (strip) WHERE dn IS NOT NULL)""",
        select="""SELECT a.strip AS s1, b.strip AS s2, count(DISTINCT a.r * 1000 + a.c) AS n_cells, count(*) AS n_pairs,
  round(sum(a.dn - b.dn) / count(*), 6) AS bias
FROM even a JOIN even b ON a.r = b.r AND a.c = b.c AND a.strip < b.strip GROUP BY ALL""",
        recursive=True,
    ),
    # strip images
    **{
        name: w(PX, select=f"SELECT {CELLS}, CASE WHEN dn >= {NODATA_BELOW} THEN dn END AS dn FROM px {where}")
        for name, where in (("raster_source", ""), ("raster_scenes", "WHERE scene_id IN (1, 3)"))
    },
    # registration
    "tile_shifts": w(
        PX, TWINS, SHIFTS,
        select="SELECT scene_a, scene_b, tile_r, tile_c, dr, dc, round(score, 9) AS score, n FROM tile_best",
    ),
    "register_shift": w(
        PX, TWINS, SHIFTS,
        "votes AS (SELECT scene_a, scene_b, dr, dc, count(*) AS votes FROM tile_best WHERE score >= 0.5 GROUP BY ALL)",
        """won AS (SELECT *, CAST(sum(votes) OVER (PARTITION BY scene_a, scene_b) AS BIGINT) AS n_tiles FROM votes
  QUALIFY row_number() OVER (PARTITION BY scene_a, scene_b ORDER BY votes DESC, abs(dr) + abs(dc), dr, dc) = 1)""",
        select="""SELECT scene_a, scene_b, dr, dc, coalesce(votes, 0) AS votes, coalesce(n_tiles, 0) AS n_tiles
FROM twin_pairs LEFT JOIN won USING (scene_a, scene_b)""",
    ),
    "align": w(
        PX, TWINS,
        select="""SELECT scene_id, CAST(CASE WHEN scene_id < 1000 THEN r ELSE r - ((scene_id - 1000) % 5 - 2) END AS INT) AS r,
  CAST(CASE WHEN scene_id < 1000 THEN c ELSE c - ((scene_id - 1000) % 3 - 1) END AS INT) AS c, dn FROM twins""",
    ),
    # flagship
    "forest_extract": w(
        PX,
        stretch_bounds("px"),
        f"st AS MATERIALIZED (SELECT {CELLS}, {stretched()} AS dn FROM px JOIN bounds USING (scene_id))",
        near(1, "st", name="sm_n"),
        f"sm AS MATERIALIZED (SELECT {CELLS}, CAST((2 * sum(v) + count(v)) // (2 * count(v)) AS INT) AS dn FROM sm_n GROUP BY {CELLS})",
        "hist AS (SELECT scene_id, dn, count(*) AS n FROM sm GROUP BY ALL)",
        otsu(),
        f"cls AS MATERIALIZED (SELECT {CELLS}, CAST(dn <= threshold AS INT) AS cls FROM sm JOIN otsu USING (scene_id))",
        morph("cls", "min", "er"),
        morph("er", "max", "op"),
        f"opened AS MATERIALIZED (SELECT {CELLS} FROM op WHERE cls = 1)",
        components("opened", 1),
        "big AS (SELECT scene_id, region_id FROM comp GROUP BY ALL HAVING sum(c1 - c0 + 1) >= %d)" % MIN_PX,
        f"kept AS ({component_cells()})",
        select=f"""SELECT op.scene_id, op.r, op.c, CAST(CASE WHEN big.region_id IS NOT NULL THEN 1 ELSE 0 END AS INT) AS cls
FROM op LEFT JOIN kept USING ({CELLS}) LEFT JOIN big ON big.scene_id = kept.scene_id AND big.region_id = kept.region_id""",
        recursive=True,
    ),
    "forest_per_scene": w(
        PX,
        HIST,
        otsu(),
        select="""SELECT scene_id, any_value(threshold) AS threshold, count(*) AS n_px,
  CAST(sum(CAST(dn <= threshold AS INT)) AS BIGINT) AS n_forest FROM px JOIN otsu USING (scene_id) GROUP BY scene_id""",
    ),
    # sources, sinks, layout
    "tiles_to_pixels": w(PX, select="SELECT * FROM px"),
    "pixels_to_tiles": w(
        PX,
        select="""SELECT scene_id, CAST(r // 16 AS INT) AS tile_r, CAST(c // 16 AS INT) AS tile_c,
  CAST(max(r % 16) + 1 AS INT) AS h, CAST(max(c % 16) + 1 AS INT) AS w, string_agg(CAST(dn AS VARCHAR), ',' ORDER BY r, c) AS dn FROM px GROUP BY 1, 2, 3""",
    ),
    "scene_catalogue": w(
        PX,
        select=f"""SELECT scene_id, min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1, count(*) AS n_cells, count(dn) AS n_valid,
  min(dn) AS dn_min, max(dn) AS dn_max, CAST(sum(dn) AS BIGINT) AS dn_sum, avg(dn) AS dn_mean, CAST({DATE} AS VARCHAR) AS acq_date FROM px GROUP BY scene_id""",
    ),
    "clip_bbox": w(PX, select=f"SELECT {CELLS}, dn FROM px WHERE r >= 10 AND r <= 59 AND c >= 5 AND c <= 44"),
    "densify": w(
        PX,
        "kept AS (SELECT * FROM px WHERE dn >= 100)",
        "box AS (SELECT scene_id, min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1 FROM kept GROUP BY scene_id)",
        """grid AS (SELECT scene_id, CAST(r AS INT) AS r, CAST(unnest(range(c0, c1 + 1)) AS INT) AS c
  FROM (SELECT *, unnest(range(r0, r1 + 1)) AS r FROM box))""",
        select=f"SELECT {CELLS}, dn FROM grid LEFT JOIN kept USING ({CELLS})",
    ),
    "scene_props": w(
        ARRIVALS, select="SELECT event_id, zone_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM arrivals"
    ),
    "write_scene_parquet": w(PX, select=f"SELECT {CELLS}, dn FROM px"),
    # radiometry
    "nodata_mask": w(PX, select=f"SELECT {CELLS}, CASE WHEN dn >= {NODATA_BELOW} AND dn <= 255 THEN dn END AS dn FROM px"),
    "apply_mask": w(PX, CLS, select=f"SELECT {CELLS}, dn FROM cls WHERE cls = 1"),
    "drop_masked": w(PX, CLS, MASK, select=f"SELECT {CELLS}, dn FROM px ANTI JOIN mask USING ({CELLS})"),
    "linear_stretch": w(
        PX,
        "bounds AS (SELECT scene_id, min(dn) AS lo, max(dn) AS hi FROM px GROUP BY scene_id)",
        select=f"SELECT {CELLS}, {stretched('dn - lo')} AS dn FROM px JOIN bounds USING (scene_id)",
    ),
    "percentile_stretch": w(
        PX, stretch_bounds("px"), select=f"SELECT {CELLS}, {stretched()} AS dn FROM px JOIN bounds USING (scene_id)"
    ),
    "zscore": w(
        PX,
        "stats AS (SELECT scene_id, avg(dn) AS m, stddev_pop(dn) AS s FROM px GROUP BY scene_id)",
        select=f"SELECT {CELLS}, round((dn - m) / s, 6) AS z FROM px JOIN stats USING (scene_id)",
    ),
    "quantize": w(PX, select=f"SELECT {CELLS}, CAST(least(7, dn * 8 // 256) AS INT) AS q FROM px"),
    "histogram": w(PX, HIST, select="SELECT * FROM hist"),
    "hist_equalize": w(
        PX,
        HIST,
        """cdf AS (SELECT a.scene_id, a.dn, sum(CASE WHEN b.dn <= a.dn THEN b.n ELSE 0 END)::DOUBLE AS cum, sum(b.n)::DOUBLE AS tot,
  FROM hist a JOIN hist b USING (scene_id) GROUP BY ALL)""",
        "lowest AS (SELECT scene_id, min(cum) AS cmin FROM cdf GROUP BY scene_id)",
        select=f"""SELECT {CELLS}, CAST(round((cum - cmin) / greatest(tot - cmin, 1) * 255) AS INT) AS dn
FROM px JOIN cdf USING (scene_id, dn) JOIN lowest USING (scene_id)""",
    ),
    "hist_match": w(
        PX,
        HIST,
        """cdf AS (SELECT a.scene_id, a.dn, sum(CASE WHEN b.dn <= a.dn THEN b.n ELSE 0 END)::DOUBLE / sum(b.n)::DOUBLE AS share
  FROM hist a JOIN hist b USING (scene_id) GROUP BY ALL)""",
        """lut AS (SELECT s.scene_id, s.dn, min(t.dn) AS to_dn FROM cdf s JOIN cdf t ON t.scene_id = 0 AND t.share >= s.share GROUP BY ALL)""",
        select=f"SELECT {CELLS}, to_dn AS dn FROM px JOIN lut USING (scene_id, dn)",
    ),
    # geometry
    "apply_affine": w(
        PX,
        COEFFS,
        select=f"SELECT {CELLS}, xc * c + xr * r + x0 AS x, yc * c + yr * r + y0 AS y FROM px JOIN coeffs USING (scene_id)",
    ),
    "downsample_mean": w(
        PX,
        select="""SELECT scene_id, CAST(r // 4 AS INT) AS r, CAST(c // 4 AS INT) AS c, avg(dn) AS dn_mean, count(dn) AS n
FROM px GROUP BY scene_id, r // 4, c // 4""",
    ),
    "downsample_mode": w(
        PX,
        CLS,
        select="""SELECT scene_id, CAST(r // 4 AS INT) AS r, CAST(c // 4 AS INT) AS c,
  CAST(CASE WHEN 2 * sum(cls) > count(*) THEN 1 ELSE 0 END AS INT) AS cls FROM cls GROUP BY scene_id, r // 4, c // 4""",
    ),
    "resample_nearest": w(
        PX,
        COEFFS,
        """box AS (SELECT scene_id, min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1 FROM px GROUP BY scene_id)""",
        """corner AS (SELECT scene_id, unnest([r0, r0, r1, r1]) AS r, unnest([c0, c1, c0, c1]) AS c FROM box)""",
        """ext AS (SELECT scene_id, min(xc * c + xr * r + x0) AS xlo, max(xc * c + xr * r + x0) AS xhi,
  min(yc * c + yr * r + y0) AS ylo, max(yc * c + yr * r + y0) AS yhi FROM corner JOIN coeffs USING (scene_id) GROUP BY scene_id)""",
        """grid AS (SELECT scene_id, i, unnest(range(0, CAST(floor((xhi - xlo) / 1.5) AS INT) + 1)) AS j, xlo, ylo
  FROM (SELECT *, unnest(range(0, CAST(floor((yhi - ylo) / 1.5) AS INT) + 1)) AS i FROM ext))""",
        """src AS (SELECT g.scene_id, CAST(i AS INT) AS i, CAST(j AS INT) AS j,
  CAST(floor(((ylo + i * 1.5::DOUBLE - y0) * xc - (xlo + j * 1.5::DOUBLE - x0) * yc) / (xc * yr - xr * yc) + 0.5) AS INT) AS r,
  CAST(floor(((xlo + j * 1.5::DOUBLE - x0) * yr - (ylo + i * 1.5::DOUBLE - y0) * xr) / (xc * yr - xr * yc) + 0.5) AS INT) AS c
  FROM grid g JOIN coeffs USING (scene_id))""",
        select=f"SELECT scene_id, i, j, dn FROM src JOIN px USING ({CELLS})",
    ),
    "fit_gcp": w(
        GCP,
        """m AS (SELECT scene_id, count(*) AS n, avg(r) AS mr, avg(c) AS mc, avg(x) AS mx, avg(y) AS my, var_pop(c) AS cc, var_pop(r) AS rr,
  covar_pop(c, r) AS cr, covar_pop(c, x) AS cx, covar_pop(r, x) AS rx, covar_pop(c, y) AS cy, covar_pop(r, y) AS ry FROM gcp GROUP BY scene_id)""",
        """s AS (SELECT *, (cx * rr - rx * cr) / (cc * rr - cr * cr) AS xc, (rx * cc - cx * cr) / (cc * rr - cr * cr) AS xr,
  (cy * rr - ry * cr) / (cc * rr - cr * cr) AS yc, (ry * cc - cy * cr) / (cc * rr - cr * cr) AS yr FROM m)""",
        select="""SELECT scene_id, n, round(xc, 4) AS xc, round(xr, 4) AS xr, round(mx - xc * mc - xr * mr, 4) AS x0,
  round(yc, 4) AS yc, round(yr, 4) AS yr, round(my - yc * mc - yr * mr, 4) AS y0 FROM s""",
    ),
    "fit_line": w(
        GCP,
        select="""SELECT scene_id, round(regr_slope(x, c), 4) AS slope, round(regr_intercept(x, c), 4) AS intercept,
  round(regr_r2(x, c), 4) AS r2 FROM gcp GROUP BY scene_id""",
    ),
    "gcp_residuals": w(
        GCP,
        """m AS (SELECT scene_id, avg(r) AS mr, avg(c) AS mc, avg(x) AS mx, avg(y) AS my, var_pop(c) AS cc, var_pop(r) AS rr,
  covar_pop(c, r) AS cr, covar_pop(c, x) AS cx, covar_pop(r, x) AS rx, covar_pop(c, y) AS cy, covar_pop(r, y) AS ry FROM gcp GROUP BY scene_id)""",
        """s AS (SELECT *, (cx * rr - rx * cr) / (cc * rr - cr * cr) AS xc, (rx * cc - cx * cr) / (cc * rr - cr * cr) AS xr,
  (cy * rr - ry * cr) / (cc * rr - cr * cr) AS yc, (ry * cc - cy * cr) / (cc * rr - cr * cr) AS yr FROM m)""",
        """d AS (SELECT scene_id, (x - mx) - xc * (c - mc) - xr * (r - mr) AS dx, (y - my) - yc * (c - mc) - yr * (r - mr) AS dy
  FROM gcp JOIN s USING (scene_id))""",
        select="""SELECT scene_id, count(*) AS n, round(sqrt(avg(dx * dx)), 4) AS rmse_x, round(sqrt(avg(dy * dy)), 4) AS rmse_y,
  round(sqrt(avg(dx * dx + dy * dy)), 4) AS rmse, round(max(sqrt(dx * dx + dy * dy)), 4) AS worst FROM d GROUP BY scene_id""",
    ),
    # mosaic
    "composite_latest": w(
        OBS,
        select="""SELECT r, c, dn FROM obs
QUALIFY row_number() OVER (PARTITION BY r, c ORDER BY acq_ts DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC) = 1""",
    ),
    "composite_median": w(OBS, select="SELECT r, c, quantile_disc(dn, 0.5) AS dn FROM obs GROUP BY r, c"),
    "composite_priority": w(
        OBS,
        select="""SELECT r, c, dn, strip FROM obs
QUALIFY row_number() OVER (PARTITION BY r, c ORDER BY strip, acq_ts DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC) = 1""",
    ),
    "mosaic_union": w(
        PX, OBS, select=f"SELECT {CELLS}, dn, CAST(NULL AS INT) AS strip FROM px UNION ALL SELECT NULL, r, c, dn, strip FROM obs"
    ),
    "seam_bias": w(
        OBS,
        select="""SELECT a.strip AS s1, b.strip AS s2, count(DISTINCT a.r * 128 + a.c) AS n_cells, count(*) AS n_pairs, avg(a.dn - b.dn) AS bias
FROM obs a JOIN obs b ON a.r = b.r AND a.c = b.c AND a.strip < b.strip GROUP BY a.strip, b.strip""",
    ),
    # focal and texture
    "focal_sum": focal(1, "CAST(sum(v) AS BIGINT) AS f_sum, count(v) AS f_n"),
    "focal_mean": focal(2, "avg(v) AS f_mean"),
    "focal_min": focal(1, "min(v) AS f_min"),
    "focal_max": focal(1, "max(v) AS f_max"),
    "focal_std": focal(1, "round(sqrt(CAST(count(v) * sum(v * v) - sum(v) * sum(v) AS DOUBLE)) / count(v), 6) AS f_std"),
    "focal_median": focal(1, "quantile_disc(v, 0.5) AS f_median"),
    "focal_majority": focal(1, "CAST(2 * sum(v) > count(v) AS INT) AS f_cls", "cls", "cls", CLS),
    "sobel": w(
        PX,
        near(1),
        f"g AS (SELECT {CELLS}, {GX} AS gx, {GY} AS gy, FROM near GROUP BY {CELLS})",
        select=f"SELECT {CELLS}, CAST(gx AS INT) AS gx, CAST(gy AS INT) AS gy, CAST(gx * gx + gy * gy AS INT) AS g2 FROM g",
    ),
    "lbp": focal(
        1,
        "CAST("
        + " + ".join(f"coalesce(CASE WHEN {at(*o)} >= any_value(v0) THEN {1 << i} ELSE 0 END, 0)" for i, o in enumerate(LBP_RING))
        + " AS INT) AS lbp",
    ),
    "convolve": focal(
        1,
        "CAST(sum(v * CASE "
        + " ".join(f"WHEN dr = {i - 1} AND dc = {j - 1} THEN {KERNEL[i][j]}" for i in range(3) for j in range(3))
        + " END) AS INT) AS f_conv",
    ),
    "glcm_features": w(
        PX,
        """pair AS (SELECT p.scene_id, least(7, p.dn * 8 // 256) AS a, least(7, q.dn * 8 // 256) AS b, count(*) AS n
  FROM px p JOIN px q ON q.scene_id = p.scene_id AND q.r = p.r AND q.c = p.c + 1 GROUP BY ALL)""",
        "prob AS (SELECT *, n / sum(n) OVER (PARTITION BY scene_id) AS p FROM pair)",
        select="""SELECT scene_id, CAST(sum(n) AS BIGINT) AS n_pairs, round(sum(p * (a - b) * (a - b)), 6) AS contrast, round(sum(p * p), 6) AS energy,
  round(sum(p / (1 + (a - b) * (a - b))), 6) AS homogeneity, round(-sum(p * ln(p)), 6) AS entropy FROM prob GROUP BY scene_id""",
    ),
    # thresholds and classes
    "threshold_fixed": w(PX, select=f"SELECT {CELLS}, CAST(dn <= {CUT} AS INT) AS cls FROM px"),
    "otsu_levels": w(PX, HIST, otsu(), select="SELECT * FROM otsu"),
    "threshold_otsu": w(
        PX, HIST, otsu(), select=f"SELECT {CELLS}, CAST(dn <= threshold AS INT) AS cls FROM px JOIN otsu USING (scene_id)"
    ),
    "threshold_local": focal(2, "CAST(any_value(v0) * count(v) < sum(v) - 5 * count(v) AS INT) AS cls"),
    "threshold_hysteresis": w(
        PX,
        CLS,
        MASK,
        components("mask", 1),
        f"cells AS ({component_cells()})",
        "strong AS (SELECT DISTINCT scene_id, region_id FROM cells JOIN px USING (scene_id, r, c) WHERE dn >= 190)",
        select=f"SELECT {CELLS} FROM cells SEMI JOIN strong USING (scene_id, region_id)",
        recursive=True,
    ),
    "texture_features": w(
        PX,
        near(1),
        f"""f AS (SELECT {CELLS}, round(avg(v), 6) AS f_mean,
  round(sqrt(CAST(count(v) * sum(v * v) - sum(v) * sum(v) AS DOUBLE)) / count(v), 6) AS f_std FROM near GROUP BY {CELLS})""",
        select=f"SELECT * FROM px JOIN f USING ({CELLS})",
    ),
    "apply_model_tiles": w(PX, select=f"SELECT {CELLS}, CAST(2 * dn - {3 * CUT} + 150 > 0 AS INT) AS cls FROM px"),
    # morphology and regions
    "erode": w(PX, CLS, morph("cls", "min", "er"), select="SELECT * FROM er"),
    "dilate": w(PX, CLS, morph("cls", "max", "di"), select="SELECT * FROM di"),
    "morph_open": w(PX, CLS, morph("cls", "min", "er"), morph("er", "max", "op"), select="SELECT * FROM op"),
    "morph_close": w(PX, CLS, morph("cls", "max", "di"), morph("di", "min", "cl"), select="SELECT * FROM cl"),
    "mask_runs": w(
        PX,
        CLS,
        MASK,
        select="""SELECT scene_id, CAST(r AS BIGINT) * 4294967296 + min(c) AS run_id, r, min(c) AS c0, max(c) AS c1
FROM (SELECT *, c - row_number() OVER (PARTITION BY scene_id, r ORDER BY c) AS g FROM mask) GROUP BY scene_id, r, g""",
    ),
    "connected_components": w(PX, CLS, MASK, components("mask", 1), select=component_cells(), recursive=True),
    "connected_components_4": w(PX, CLS, MASK, components("mask", 0), select=component_cells(), recursive=True),
    "region_stats": w(
        PX,
        CLS,
        MASK,
        components("mask", 1),
        f"cells AS ({component_cells()})",
        select="""SELECT scene_id, region_id, count(*) AS n_px, min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1, avg(dn) AS dn_mean,
  count(*) / ((max(r) - min(r) + 1) * (max(c) - min(c) + 1)) AS fill
FROM cells JOIN px USING (scene_id, r, c) GROUP BY scene_id, region_id""",
        recursive=True,
    ),
    "sieve": w(
        PX,
        CLS,
        MASK,
        components("mask", 1),
        "big AS (SELECT scene_id, region_id FROM comp GROUP BY ALL HAVING sum(c1 - c0 + 1) >= %d)" % MIN_PX,
        f"cells AS ({component_cells()})",
        f"kept AS (SELECT {CELLS} FROM cells JOIN big USING (scene_id, region_id))",
        select=f"""SELECT p.scene_id, p.r, p.c, CAST(k.r IS NOT NULL AS INT) AS cls
FROM px p LEFT JOIN kept k ON k.scene_id = p.scene_id AND k.r = p.r AND k.c = p.c""",
        recursive=True,
    ),
    "fill_holes": w(
        PX,
        CLS,
        f"gaps AS MATERIALIZED (SELECT {CELLS} FROM cls WHERE cls = 0)",
        components("gaps", 0),
        f"cells AS MATERIALIZED ({component_cells()})",
        """edge AS (SELECT DISTINCT scene_id, region_id FROM cells JOIN
  (SELECT scene_id, max(r) AS r1, max(c) AS c1 FROM px GROUP BY scene_id) USING (scene_id) WHERE r = 0 OR c = 0 OR r = r1 OR c = c1
  UNION SELECT DISTINCT a.scene_id, a.region_id FROM cells a JOIN cls b ON b.scene_id = a.scene_id AND b.cls IS NULL
    AND abs(a.r - b.r) + abs(a.c - b.c) = 1 AND b.r BETWEEN a.r - 1 AND a.r + 1)""",
        f"open_cells AS (SELECT {CELLS} FROM cells SEMI JOIN edge USING (scene_id, region_id))",
        select=f"""SELECT p.scene_id, p.r, p.c, CASE WHEN p.dn IS NOT NULL THEN CAST(k.r IS NULL AS INT) END AS cls
FROM px p LEFT JOIN open_cells k ON k.scene_id = p.scene_id AND k.r = p.r AND k.c = p.c""",
        recursive=True,
    ),
    "boundary_pixels": w(
        PX, CLS, MASK, morph("cls", "min", "er"), select=f"SELECT {CELLS} FROM mask EXCEPT SELECT {CELLS} FROM er WHERE cls = 1"
    ),
    "perimeter": w(
        PX,
        CLS,
        MASK,
        morph("cls", "min", "er"),
        f"b AS (SELECT {CELLS} FROM mask EXCEPT SELECT {CELLS} FROM er WHERE cls = 1)",
        select="SELECT scene_id, count(*) AS n_boundary FROM b GROUP BY scene_id",
    ),
    "top_regions": w(
        PX,
        CLS,
        MASK,
        components("mask", 1),
        "areas AS (SELECT scene_id, region_id, CAST(sum(c1 - c0 + 1) AS BIGINT) AS n_px FROM comp GROUP BY ALL)",
        select="""SELECT scene_id, CAST(row_number() OVER (PARTITION BY scene_id ORDER BY n_px DESC, region_id) AS INT) AS place, region_id, n_px
FROM areas QUALIFY place <= 5""",
        recursive=True,
    ),
    "largest_regions": w(
        PX,
        CLS,
        MASK,
        components("mask", 1),
        select="""SELECT scene_id, region_id, CAST(sum(c1 - c0 + 1) AS BIGINT) AS n_px FROM comp GROUP BY scene_id, region_id
ORDER BY n_px DESC, scene_id, region_id LIMIT 20""",
        recursive=True,
    ),
    # zones
    "points_in_polygon": w(
        PX,
        """corner AS (SELECT n_nationkey AS zone_id, k, CAST((n_nationkey * 7) % 80 + [0, 30, 10][k + 1] AS DOUBLE) AS y,
  CAST((n_nationkey * 11) % 80 + [0, 5, 40][k + 1] AS DOUBLE) AS x FROM nation, range(3) t(k))""",
        "edge AS (SELECT a.zone_id, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM corner a JOIN corner b ON b.zone_id = a.zone_id AND b.k = (a.k + 1) % 3)",
        f"""hit AS (SELECT {CELLS}, dn, edge.zone_id FROM px, edge WHERE (y1 > r + 0.5) <> (y2 > r + 0.5)
  AND c + 0.5::DOUBLE < (x2 - x1) * ((r + 0.5::DOUBLE) - y1) / (y2 - y1) + x1)""",
        select=f"SELECT {CELLS}, dn, zone_id FROM hit GROUP BY ALL HAVING count(*) % 2 = 1",
    ),
    "zonal_stats": w(
        PX,
        CLS,
        ZONES,
        select="""SELECT zone_id, zone, region, count(dn) AS n_px, avg(dn) AS dn_mean, min(dn) AS dn_min, max(dn) AS dn_max, avg(cls) AS forest_share
FROM cls JOIN zones USING (zone_id) GROUP BY ALL""",
    ),
    "zonal_rollup": w(
        PX,
        CLS,
        ZONES,
        ZSUM,
        select=f"""SELECT region, zone, CAST(grouping(region, zone) AS INT) AS level, {MERGED}
FROM zsum LEFT JOIN zones USING (zone_id) GROUP BY ROLLUP (region, zone)""",
    ),
    "zonal_cube": w(
        PX,
        CLS,
        ZONES,
        ZSUM,
        select=f"""SELECT region, scene_id, CAST(grouping(region, scene_id) AS INT) AS level, {MERGED}
FROM zsum LEFT JOIN zones USING (zone_id) GROUP BY CUBE (region, scene_id)""",
    ),
    "zonal_histogram": w(
        PX,
        select="SELECT zone_id, "
        + ", ".join(f"count(CASE WHEN dn // 32 = {i} THEN 1 END) AS b{i}" for i in range(8))
        + " FROM px GROUP BY zone_id",
    ),
    "zone_coverage": w(
        PX,
        ZONES,
        select="""SELECT z.zone_id, z.zone, count(p.dn) AS n_valid FROM zones z LEFT JOIN px p ON p.zone_id = z.zone_id AND p.dn > 235
GROUP BY ALL""",
    ),
    "distinct_classes": w(PX, select="SELECT zone_id, count(DISTINCT dn) AS n_levels, count(*) AS n_px FROM px GROUP BY zone_id"),
    # change
    "transition_matrix": w(
        PX,
        CLS,
        STEPS,
        select="SELECT was_scene AS scene_id, was, cls AS now, count(*) AS n FROM steps GROUP BY ALL",
    ),
    "forest_gain": w(PX, CLS, STEPS, select="SELECT was_scene AS scene_id, r, c FROM steps WHERE was = 0 AND cls = 1"),
    "forest_loss": w(PX, CLS, STEPS, select="SELECT was_scene AS scene_id, r, c FROM steps WHERE was = 1 AND cls = 0"),
    "forest_stable": w(PX, CLS, STEPS, select="SELECT was_scene AS scene_id, r, c FROM steps WHERE was = 1 AND cls = 1"),
    "first_loss": w(
        PX,
        CLS,
        STEPS,
        select=f"SELECT r, c, CAST(min({DATE}) AS VARCHAR) AS first_loss FROM steps WHERE was = 1 AND cls = 0 GROUP BY r, c",
    ),
    "area_by_year": w(
        PX,
        CLS,
        f"""l AS (SELECT zone_id, CAST(year({DATE}) AS INT) AS year, cls FROM cls WHERE cls IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY zone_id, r, c, year({DATE}) ORDER BY scene_id DESC) = 1)""",
        "y AS (SELECT zone_id, year, CAST(sum(cls) AS BIGINT) AS n_forest FROM l GROUP BY ALL)",
        select="SELECT *, n_forest - lag(n_forest) OVER (PARTITION BY zone_id ORDER BY year) AS change FROM y",
    ),
    "pixel_series": w(
        OBS,
        select="""SELECT r, c, acq_ts, l_orderkey, l_linenumber, l_partkey, dn, lag(dn) OVER s AS prev_dn, dn - lag(dn) OVER s AS diff,
  count(dn) OVER s AS n_so_far, avg(dn) OVER s AS mean_so_far FROM obs
WINDOW s AS (PARTITION BY r, c ORDER BY acq_ts, l_orderkey, l_linenumber, l_partkey ROWS UNBOUNDED PRECEDING)""",
    ),
    "asof_scene": w(
        ARRIVALS,
        """best AS (SELECT q.event_id, q.zone_id, q.ts, s.event_id AS scene_event, s.ts AS scene_ts
  FROM arrivals q LEFT JOIN arrivals s ON s.kind = 'signup' AND s.zone_id = q.zone_id AND s.ts <= q.ts WHERE q.kind = 'purchase'
  QUALIFY row_number() OVER (PARTITION BY q.event_id ORDER BY s.ts DESC NULLS LAST, s.event_id DESC) = 1)""",
        select="SELECT * FROM best",
    ),
    # samples and accuracy
    "stratified_sample": w(
        PX,
        f"h AS (SELECT {CELLS}, truth, {HASH} AS h FROM px)",
        select=f"""SELECT *, CAST(row_number() OVER (PARTITION BY truth ORDER BY h, {CELLS}) AS INT) AS place FROM h QUALIFY place <= 500""",
    ),
    "block_split": w(PX, select=f"SELECT {CELLS}, CASE WHEN {BLOCK_HASH} % 100 < 30 THEN 'test' ELSE 'train' END AS part FROM px"),
    "confusion_matrix": w(PX, CLS, select="SELECT cls, truth, count(*) AS n FROM cls GROUP BY ALL"),
    "accuracy_scores": w(
        PX,
        CLS,
        """k AS (SELECT scene_id, count(*) FILTER (cls = 1 AND truth = 1) AS tp, count(*) FILTER (cls = 1 AND truth = 0) AS fp,
  count(*) FILTER (cls = 0 AND truth = 1) AS fn, count(*) FILTER (cls = 0 AND truth = 0) AS tn FROM cls GROUP BY scene_id)""",
        select="""SELECT *, (tp + tn) / (tp + fp + fn + tn) AS overall, tp / (tp + fn) AS producers, tp / (tp + fp) AS users,
  2 * tp / (2 * tp + fp + fn) AS f1, tp / (tp + fp + fn) AS iou FROM k""",
    ),
    "kappa": w(
        PX,
        CLS,
        """k AS (SELECT scene_id, count(*)::DOUBLE AS n, count(*) FILTER (cls = truth)::DOUBLE AS hit,
  sum(cls)::DOUBLE AS m1, sum(truth)::DOUBLE AS t1 FROM cls GROUP BY scene_id)""",
        "p AS (SELECT scene_id, hit / n AS observed, (m1 * t1 + (n - m1) * (n - t1)) / (n * n) AS expected FROM k)",
        select="SELECT *, round((observed - expected) / (1 - expected), 6) AS kappa FROM p",
    ),
    "threshold_sweep": w(
        PX,
        "h AS (SELECT scene_id, dn, sum(truth) AS f, count(*) AS n FROM px GROUP BY ALL)",
        """s AS (SELECT a.scene_id, a.dn AS t, CAST(sum(CASE WHEN b.dn <= a.dn THEN b.f ELSE 0 END) AS BIGINT) AS tp,
  CAST(sum(CASE WHEN b.dn <= a.dn THEN b.n - b.f ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN b.dn > a.dn THEN b.f ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN b.dn > a.dn THEN b.n - b.f ELSE 0 END) AS BIGINT) AS tn FROM h a JOIN h b USING (scene_id) GROUP BY ALL)""",
        select="SELECT scene_id, t, tp, fp, (tp + tn) / (tp + fp + fn + tn) AS overall, tp / (tp + fn + fp) AS iou FROM s",
    ),
    "area_adjusted": w(
        PX,
        CLS,
        f"h AS (SELECT {CELLS}, cls, truth, {HASH} AS h FROM cls)",
        f"sample AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY cls ORDER BY h, {CELLS}) <= 1000)",
        "strata AS (SELECT cls, count(*) / (SELECT count(*) FROM cls) AS w FROM cls GROUP BY cls)",
        "row_n AS (SELECT cls, count(*) AS n_row FROM sample GROUP BY cls)",
        """cell AS (SELECT s.cls, t.truth, s.w, n_row, (SELECT count(*) FROM sample x WHERE x.cls = s.cls AND x.truth = t.truth) / n_row AS p
  FROM strata s JOIN row_n USING (cls), (VALUES (0), (1)) t(truth))""",
        select="""SELECT truth, round(sum(w * p), 6) AS area_share, round(sum(w * p) * (SELECT count(*) FROM cls), 3) AS area_px,
  round(sqrt(sum(w * w * p * (1 - p) / (n_row - 1))), 6) AS std_error FROM cell GROUP BY truth""",
    ),
    # streams
    "stream_tumbling": w(
        ARRIVALS,
        """t AS (SELECT date_trunc('hour', ts) AS w_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS w_end, kind, count(*) AS n
  FROM arrivals GROUP BY ALL)""",
        select=f"SELECT * FROM t WHERE {CLOSED}",
    ),
    "stream_sliding": w(
        ARRIVALS,
        """t AS (SELECT date_trunc('hour', ts) - INTERVAL 1 HOUR * k AS w_start, date_trunc('hour', ts) + INTERVAL 1 HOUR * (2 - k) AS w_end,
  kind, count(*) AS n FROM arrivals, range(2) t(k) GROUP BY ALL)""",
        select=f"SELECT * FROM t WHERE {CLOSED}",
    ),
    "stream_session": w(
        ARRIVALS,
        """g AS (SELECT *, CASE WHEN ts <= lag(ts) OVER s + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM arrivals
  WINDOW s AS (PARTITION BY source_id ORDER BY ts, event_id))""",
        "k AS (SELECT *, sum(fresh) OVER (PARTITION BY source_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM g)",
        """t AS (SELECT min(ts) AS w_start, max(ts) + INTERVAL 30 MINUTE AS w_end, source_id, count(*) AS n FROM k GROUP BY source_id, run)""",
        select=f"SELECT * FROM t WHERE {CLOSED}",
    ),
    "stream_interval_join": w(
        ARRIVALS,
        select="""SELECT a.source_id, a.event_id AS first_id, b.event_id AS then_id, a.ts AS first_ts, b.ts AS then_ts
FROM arrivals a JOIN arrivals b ON a.source_id = b.source_id AND a.kind = 'click' AND b.kind = 'purchase'
 AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 1 HOUR""",
    ),
    "stream_dedup": w(ARRIVALS, select="SELECT event_id, ts, kind, zone_id FROM arrivals"),
    "stream_enrich": w(
        ARRIVALS, ZONES, select="SELECT event_id, ts, kind, zone, region FROM arrivals JOIN zones USING (zone_id)"
    ),
    "stream_zonal_totals": w(
        ARRIVALS, select="SELECT zone_id, count(*) AS n, round(sum(value), 4) AS total FROM arrivals GROUP BY zone_id"
    ),
    "stream_late_rows": w(
        ARRIVALS,
        """t AS (SELECT date_trunc('hour', ts) AS w_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS w_end, count(*) AS n_all,
  bool_and(day(ts) >= 21) AS in_time FROM arrivals GROUP BY ALL)""",
        select=f"""SELECT w_start, w_end, CAST(CASE WHEN in_time THEN n_all ELSE 0 END AS BIGINT) AS n_kept,
  CAST(CASE WHEN in_time THEN 0 ELSE n_all END AS BIGINT) AS n_late FROM t WHERE {CLOSED}""",
    ),
    # user functions
    "tile_map": w(PX, select=f"SELECT {CELLS}, 255 - dn AS dn FROM px"),
    "tile_map_halo": focal(1, "CAST(sum(v) AS INT) AS f_sum"),
    "tile_median": focal(1, "quantile_disc(v, 0.5) AS f_median"),
    "tile_entropy": w(
        PX,
        "n AS (SELECT scene_id, CAST(r // 16 AS INT) AS tile_r, CAST(c // 16 AS INT) AS tile_c, dn, count(*) AS n FROM px GROUP BY ALL)",
        "p AS (SELECT *, n / sum(n) OVER (PARTITION BY scene_id, tile_r, tile_c) AS p FROM n)",
        select="SELECT scene_id, tile_r, tile_c, round(-sum(p * ln(p)), 6) AS entropy FROM p GROUP BY scene_id, tile_r, tile_c",
    ),
    "tile_px": w(PX, select=f"SELECT {CELLS}, dn FROM px"),
}

# the tile form answers the same question
ORACLES["forest_extract_tiles"] = ORACLES["forest_extract"]


# the same with nodata: only the input differs
PX_NODATA = PX.replace("px AS MATERIALIZED", "whole AS MATERIALIZED", 1) + f""", px AS MATERIALIZED (
  SELECT * REPLACE (CASE WHEN dn >= {NODATA_BELOW} THEN dn END AS dn) FROM whole
)"""
OBS_NODATA = OBS.replace("CAST(l_quantity * 5 AS INT) AS dn", f"CASE WHEN l_quantity * 5 >= {NODATA_BELOW} THEN CAST(l_quantity * 5 AS INT) END AS dn")
for _name in (
    "focal_mean", "focal_median", "connected_components", "region_stats", "fill_holes", "transition_matrix", "forest_loss",
    "forest_gain", "first_loss", "area_by_year", "forest_per_scene",
):
    ORACLES[f"{_name}_nodata"] = ORACLES[_name].replace(PX, PX_NODATA)
for _name in ("threshold_otsu", "accuracy_scores"):
    ORACLES[f"{_name}_nodata"] = ORACLES[_name].replace(PX, PX_NODATA)
# where only valid pixels count
PX_VALID = PX.replace("px AS MATERIALIZED", "whole AS MATERIALIZED", 1) + f", px AS MATERIALIZED (SELECT * FROM whole WHERE dn >= {NODATA_BELOW})"
for _name in ("kappa", "forest_per_scene"):
    ORACLES[f"{_name}_nodata"] = ORACLES[_name].replace(PX, PX_VALID)
ORACLES["percentile_stretch_nodata"] = (
    f"SELECT {CELLS}, dn FROM ({ORACLES['percentile_stretch'].replace(PX, PX_VALID)}) UNION ALL "
    f"SELECT {CELLS}, CAST(NULL AS INT) AS dn FROM ({w(PX, select=f'SELECT * FROM px WHERE dn < {NODATA_BELOW}')})"
)
ORACLES["composite_latest_nodata"] = w(
    OBS_NODATA,
    select="""SELECT r, c, dn FROM obs QUALIFY row_number() OVER (PARTITION BY r, c
  ORDER BY dn IS NULL, acq_ts DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC) = 1""",
)
ORACLES["composite_priority_nodata"] = w(
    OBS_NODATA,
    select="""SELECT r, c, dn, strip FROM obs QUALIFY row_number() OVER (PARTITION BY r, c
  ORDER BY dn IS NULL, strip, acq_ts DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC) = 1""",
)
ORACLES["zonal_histogram_10"] = w(
    PX,
    select="SELECT zone_id, "
    + ", ".join(f"count(CASE WHEN dn * 10 // 256 = {i} THEN 1 END) AS b{i}" for i in range(10))
    + " FROM px GROUP BY zone_id",
)
ORACLES["stratified_sample_5000"] = ORACLES["stratified_sample"].replace("place <= 500", "place <= 5000")
ORACLES["kmeans_properties"] = w(PX_NODATA, select="SELECT scene_id, count(*) AS n_px, count(dn) AS n_cls, true AS in_range FROM px GROUP BY scene_id")
ORACLES["rf_properties"] = w(
    PX_NODATA, select=f"SELECT truth, count(*) AS n_px, count(dn) AS n_cls, true AS in_range FROM px WHERE {BLOCK_HASH} % 100 < 30 GROUP BY truth"
)
ORACLES["distinct_properties"] = w(PX, select="SELECT zone_id, count(DISTINCT dn) AS n_levels, true AS near FROM px GROUP BY zone_id")
