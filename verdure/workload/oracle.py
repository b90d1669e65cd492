"""Independent DuckDB SQL for the registered queries, by brute force where that is exact.

``SQL`` maps a query name to one statement over the given tables. Shared steps are kept
once in ``STEPS`` and pulled into a statement as common table expressions.
"""

from __future__ import annotations

import math
import re


def _ellipsoid_constants() -> tuple[str, ...]:
    """GRS80 and EPSG:3035 constants, each as the shortest text of its double."""
    f = 1 / 298.257222101
    e2 = f * (2 - f)
    e = math.sqrt(e2)
    sin0 = math.sin(math.radians(52))

    def q(s: float) -> float:
        return (1 - e2) * (s / (1 - e2 * s * s) + math.atanh(e * s) / e)

    qp = q(1.0)
    b0, rq = math.asin(q(sin0) / qp), 6378137 * math.sqrt(qp / 2)
    d = 6378137 * math.cos(math.radians(52)) / math.sqrt(1 - e2 * sin0 * sin0) / (rq * math.cos(b0))
    return tuple(map(repr, (e2, qp, rq, d, e, b0)))


E2, QP, RQ, D, ECC, B0 = _ellipsoid_constants()

STEPS: dict[str, str] = {}
SQL: dict[str, str] = {}


def step(name: str, sql: str) -> None:
    STEPS[name] = sql.strip()


def statement(sql: str) -> str:
    """Prefix ``sql`` with the steps it names, in dependency order."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in STEPS:
            if name not in order and re.search(rf"\b{name}\b", text):
                inside = re.sub(rf"\b{name}\b", " ", STEPS[name])
                need(inside)
                if name not in order:
                    order.append(name)

    need(sql)
    ctes = ",\n".join(f"{n} AS ({STEPS[n]})" for n in order)
    return f"WITH RECURSIVE {ctes}\n{sql.strip()}" if order else sql.strip()


def laea(lon: str, lat: str) -> tuple[str, str]:
    """SQL for EPSG:3035 x and y of degrees, from the authalic latitude."""
    s = f"sin(radians({lat}))"
    q = (
        f"((1 - {E2}::DOUBLE) * ({s} / (1 - {E2}::DOUBLE * {s} * {s}) - "
        f"ln((1 - {ECC}::DOUBLE * {s}) / (1 + {ECC}::DOUBLE * {s})) / (2 * {ECC}::DOUBLE)))"
    )
    b = f"asin({q} / {QP}::DOUBLE)"
    dl = f"radians({lon} - 10)"
    k = (
        f"({RQ}::DOUBLE * sqrt(2 / (1 + sin({B0}::DOUBLE) * sin({b}) + "
        f"cos({B0}::DOUBLE) * cos({b}) * cos({dl}))))"
    )
    x = f"(4321000 + {k} * {D}::DOUBLE * cos({b}) * sin({dl}))"
    y = (
        f"(3210000 + {k} / {D}::DOUBLE * (cos({B0}::DOUBLE) * sin({b}) - "
        f"sin({B0}::DOUBLE) * cos({b}) * cos({dl})))"
    )
    return x, y


def unlaea(x: str, y: str) -> tuple[str, str]:
    """SQL for degrees of EPSG:3035 x and y, with the latitude series of the method."""
    dx, dy = f"({x} - 4321000)", f"({y} - 3210000)"
    rho = f"sqrt(({dx} / {D}::DOUBLE) * ({dx} / {D}::DOUBLE) + ({D}::DOUBLE * {dy}) * ({D}::DOUBLE * {dy}))"
    c = f"(2 * asin({rho} / (2 * {RQ}::DOUBLE)))"
    b = (
        f"asin(cos({c}) * sin({B0}::DOUBLE) + {D}::DOUBLE * {dy} * sin({c}) * cos({B0}::DOUBLE) / {rho})"
    )
    lon = (
        f"(10 + degrees(atan2({dx} * sin({c}), {D}::DOUBLE * {rho} * cos({B0}::DOUBLE) * cos({c}) - "
        f"{D}::DOUBLE * {D}::DOUBLE * {dy} * sin({B0}::DOUBLE) * sin({c}))))"
    )
    e2 = float(E2)
    t2 = repr(e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040)
    t4 = repr(23 * e2**2 / 360 + 251 * e2**3 / 3780)
    t6 = repr(761 * e2**3 / 45360)
    lat = (
        f"degrees({b} + {t2}::DOUBLE * sin(2 * {b}) + {t4}::DOUBLE * sin(4 * {b}) + "
        f"{t6}::DOUBLE * sin(6 * {b}))"
    )
    return lon, lat


# --- fields and their metre geometry -----------------------------------------------

step(
    "v_fields",
    """
SELECT vec_id AS ord, 'F' || vec_id AS field_id,
  6 + 4 * embedding[1]::DOUBLE AS cx, 50.5::DOUBLE + 4 * embedding[2]::DOUBLE AS cy,
  0.01::DOUBLE + 0.1::DOUBLE * abs(embedding[3]::DOUBLE) AS hw,
  0.01::DOUBLE + 0.1::DOUBLE * abs(embedding[4]::DOUBLE) AS hh,
  0.02::DOUBLE * embedding[5]::DOUBLE AS sk,
  CASE WHEN label = 9 THEN NULL ELSE DATE '2024-01-01' + CAST(vec_id % 30 AS INTEGER) END AS planting_date
FROM embeddings
""",
)
step(
    "v_vertices",
    """
SELECT ord, k,
  CASE k WHEN 0 THEN cx - hw WHEN 1 THEN cx + hw WHEN 2 THEN cx + hw + sk ELSE cx - hw + sk END AS lon,
  CASE WHEN k < 2 THEN cy - hh ELSE cy + hh END AS lat
FROM v_fields, range(4) r(k)
""",
)
_x, _y = laea("lon", "lat")
step("v_metres", f"SELECT ord, k, {_x} AS px, {_y} AS py FROM v_vertices")
step(
    "v_centroids",
    """
SELECT ord, round(any_value(ox) + sum((ax + bx) * (ax * by_ - bx * ay)) / (3 * sum(ax * by_ - bx * ay)), 3) AS x,
  round(any_value(oy) + sum((ay + by_) * (ax * by_ - bx * ay)) / (3 * sum(ax * by_ - bx * ay)), 3) AS y
FROM (SELECT a.ord, o.px AS ox, o.py AS oy, a.px - o.px AS ax, a.py - o.py AS ay, b.px - o.px AS bx, b.py - o.py AS by_
  FROM v_metres a JOIN v_metres b ON a.ord = b.ord AND b.k = (a.k + 1) % 4
  JOIN v_metres o ON o.ord = a.ord AND o.k = 0) GROUP BY ord
""",
)
step(
    "v_nearest",
    """
SELECT a.ord, min(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))) AS nn_dist
FROM v_centroids a JOIN v_centroids b ON a.ord <> b.ord GROUP BY a.ord
""",
)
step(
    "v_eps",
    """
SELECT greatest(1000.0::DOUBLE, lo + (hi - lo) * (h - floor(h))) AS eps FROM (
  SELECT any_value(h) AS h, max(CASE WHEN r = floor(h) THEN nn_dist END) AS lo,
    max(CASE WHEN r = ceil(h) THEN nn_dist END) AS hi
  FROM (SELECT nn_dist, row_number() OVER (ORDER BY nn_dist) - 1 AS r, (count(*) OVER () - 1) * 0.9::DOUBLE AS h
    FROM v_nearest))
""",
)
step(
    "v_pairs",
    """
SELECT a.ord AS a, b.ord AS b, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS dist
FROM v_centroids a JOIN v_centroids b ON a.ord <> b.ord JOIN v_eps ON true
WHERE sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= eps
""",
)


def clustering(tag: str, pairs: str, min_samples: int) -> None:
    """Steps up to ``labels_<tag>`` (ord, label) and ``clusters_<tag>`` (ord, label, cluster)."""
    step(
        f"core_{tag}",
        f"SELECT c.ord FROM v_centroids c LEFT JOIN {pairs} p ON p.a = c.ord GROUP BY c.ord "
        f"HAVING count(p.b) + 1 >= {min_samples}",
    )
    step(
        f"links_{tag}",
        f"SELECT a, b FROM {pairs} WHERE a IN (SELECT ord FROM core_{tag}) AND b IN (SELECT ord FROM core_{tag})",
    )
    step(
        f"reach_{tag}",
        f"SELECT ord AS root, ord FROM core_{tag} UNION "
        f"SELECT r.root, l.b FROM reach_{tag} r JOIN links_{tag} l ON l.a = r.ord",
    )
    step(f"roots_{tag}", f"SELECT ord, min(root) AS root FROM reach_{tag} GROUP BY ord")
    step(
        f"rooted_{tag}",
        f"SELECT ord, root FROM roots_{tag} UNION ALL "
        f"SELECT p.a, min(r.root) FROM {pairs} p JOIN roots_{tag} r ON r.ord = p.b "
        f"WHERE p.a NOT IN (SELECT ord FROM core_{tag}) GROUP BY p.a",
    )
    step(
        f"labels_{tag}",
        f"SELECT c.ord, coalesce(n.label, -1) AS label FROM v_centroids c "
        f"LEFT JOIN rooted_{tag} t ON t.ord = c.ord LEFT JOIN "
        f"(SELECT root, row_number() OVER (ORDER BY root) - 1 AS label FROM "
        f"(SELECT DISTINCT root FROM roots_{tag})) n ON n.root = t.root",
    )
    step(
        f"clusters_{tag}",
        f"SELECT ord, label, CASE WHEN max(label) OVER () < 0 THEN 0 WHEN label >= 0 THEN label ELSE "
        f"max(label) OVER () + row_number() OVER (PARTITION BY label < 0 ORDER BY ord) END AS cluster "
        f"FROM labels_{tag}",
    )


step("v_pairs1", "SELECT a, b FROM (SELECT a.ord AS a, b.ord AS b, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS dist FROM v_centroids a JOIN v_centroids b ON a.ord <> b.ord) WHERE dist <= 1.0")
clustering("m2", "v_pairs", 2)
clustering("m5", "v_pairs", 5)
clustering("m2far", "v_pairs1", 2)

step(
    "v_numbers",
    """
SELECT cluster, 'AOI_' || CASE WHEN n < 10 THEN '0' || n ELSE '' || n END AS aoi_id, n FROM (
  SELECT cluster, row_number() OVER (ORDER BY cluster) AS n FROM (SELECT DISTINCT cluster FROM clusters_m2))
""",
)
step(
    "v_tagged",
    """
SELECT f.*, n.aoi_id, n.n AS aoi_no FROM v_fields f JOIN clusters_m2 c ON c.ord = f.ord
JOIN v_numbers n ON n.cluster = c.cluster
""",
)
_lon, _lat = unlaea("x", "y")
step(
    "v_aois",
    f"""
SELECT aoi_id, any_value(aoi_no) AS aoi_no, min(lon) AS minlon, min(lat) AS minlat, max(lon) AS maxlon, max(lat) AS maxlat
FROM (SELECT aoi_id, aoi_no, {_lon} AS lon, {_lat} AS lat FROM (
  SELECT aoi_id, any_value(aoi_no) AS aoi_no, unnest([min(px) - 2000, min(px) - 2000, max(px) + 2000, max(px) + 2000]) AS x,
    unnest([min(py) - 2000, max(py) + 2000, min(py) - 2000, max(py) + 2000]) AS y
  FROM v_metres m JOIN v_tagged t ON t.ord = m.ord GROUP BY aoi_id)) GROUP BY aoi_id
""",
)
step(
    "v_days",
    """
SELECT CAST(d AS DATE) AS date FROM (SELECT unnest(generate_series(
  (SELECT CAST(min(planting_date) AS TIMESTAMP) FROM v_fields), TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS d)
""",
)
step("v_aoi_days", "SELECT a.*, d.date, a.aoi_no + day(d.date) AS turn FROM v_aois a, v_days d")

# --- scenes ------------------------------------------------------------------------

step(
    "v_scenes",
    """
SELECT 'S2_' || event_id AS item_id, event_id, ts AS dt, event_type,
  CASE WHEN event_type = 'error' THEN NULL ELSE round(value % 100, 2) END AS cloud_cover,
  4.5::DOUBLE + (user_id % 15) * 0.2::DOUBLE AS xmin, 49.0::DOUBLE + ((user_id // 15) % 10) * 0.3::DOUBLE AS ymin,
  4.5::DOUBLE + (user_id % 15) * 0.2::DOUBLE + 1.0::DOUBLE AS xmax,
  49.0::DOUBLE + ((user_id // 15) % 10) * 0.3::DOUBLE + 0.7::DOUBLE AS ymax,
  CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) % 4 AS k,
  CASE event_type WHEN 'view' THEN 'B04' WHEN 'click' THEN 'B04_10m' WHEN 'signup' THEN 'red' WHEN 'purchase' THEN 'b04' END AS b04_asset,
  CASE event_type WHEN 'view' THEN 'B08' WHEN 'click' THEN 'B08_10m' WHEN 'signup' THEN 'nir' WHEN 'purchase' THEN 'b08' END AS b08_asset
FROM events
""",
)
step(
    "v_candidates",
    """
SELECT a.aoi_id, CAST(s.dt AS DATE) AS date, s.* FROM v_aois a JOIN v_scenes s
  ON a.minlon <= s.xmax AND a.maxlon >= s.xmin AND a.minlat <= s.ymax AND a.maxlat >= s.ymin
WHERE s.cloud_cover < 30
""",
)
step(
    "v_best",
    """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY aoi_id, date ORDER BY cloud_cover, dt, item_id) AS rank
FROM v_candidates) WHERE rank = 1
""",
)
step(
    "v_refs",
    """
SELECT d.aoi_id, d.date, d.turn, CASE WHEN b.item_id IS NULL THEN 'no_items' ELSE 'ok' END AS status,
  d.minlon, d.minlat, d.maxlon, d.maxlat, b.dt AS item_datetime, b.cloud_cover,
  CASE WHEN b.item_id IS NOT NULL THEN 'sentinel-2-l2a' END AS collection, b.item_id, b.event_id, b.b04_asset, b.b08_asset, b.k
FROM v_aoi_days d LEFT JOIN v_best b ON b.aoi_id = d.aoi_id AND b.date = d.date
""",
)
EPSG = "CASE k WHEN 0 THEN 32632 WHEN 1 THEN 32631 WHEN 2 THEN 32633 END"

# --- pixels and masks --------------------------------------------------------------

step(
    "v_pixels",
    """
SELECT CAST(l_suppkey % 4 AS VARCHAR) AS item_id, l_orderkey % 128 AS row, l_partkey % 128 AS col,
  l_orderkey AS obs_order, CAST(l_linenumber AS BIGINT) AS obs_line,
  CASE WHEN l_quantity = 1 THEN NULL ELSE round(l_tax * 10000) END AS red_raw,
  CASE WHEN l_quantity = 1 THEN NULL ELSE round(l_discount * 10000) END AS nir_raw
FROM lineitem
""",
)
step(
    "v_ndvi",
    """
SELECT item_id, row, col, obs_order, obs_line, red, nir, CASE WHEN nir + red <> 0 THEN (nir - red) / (nir + red) END AS ndvi
FROM (SELECT *, red_raw * 0.0001::DOUBLE AS red, nir_raw * 0.0001::DOUBLE AS nir FROM v_pixels)
""",
)
step(
    "v_edges",
    """
SELECT a.ord, a.lon AS x1, a.lat AS y1, b.lon AS x2, b.lat AS y2
FROM v_vertices a JOIN v_vertices b ON a.ord = b.ord AND b.k = (a.k + 1) % 4
""",
)
step(
    "v_boxes",
    "SELECT ord, min(lon) AS xmin, min(lat) AS ymin, max(lon) AS xmax, max(lat) AS ymax FROM v_vertices GROUP BY ord",
)


def covered(tag: str, res: str, size: int) -> None:
    """``cells_<tag>``: grid cells whose centre lies in a field, with the first planting date.

    Plain even-odd test of every cell centre against the edges of every field near it.
    """
    step(
        f"grid_{tag}",
        f"SELECT r.row, c.col, 4.5::DOUBLE + (c.col + 0.5::DOUBLE) * {res}::DOUBLE AS x, "
        f"52.0::DOUBLE - (r.row + 0.5::DOUBLE) * {res}::DOUBLE AS y FROM range({size}) r(row), range({size}) c(col)",
    )
    step(
        f"cells_{tag}",
        f"""SELECT t.aoi_id, h.row, h.col, min(t.planting_date) AS planted FROM (
  SELECT b.ord, g.row, g.col FROM v_boxes b JOIN grid_{tag} g
    ON g.x BETWEEN b.xmin AND b.xmax AND g.y BETWEEN b.ymin AND b.ymax
  JOIN v_edges e ON e.ord = b.ord AND least(e.y1, e.y2) <= g.y AND g.y < greatest(e.y1, e.y2)
    AND e.x1 + (g.y - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) <= g.x
  GROUP BY b.ord, g.row, g.col HAVING count(*) % 2 = 1) h
JOIN v_tagged t ON t.ord = h.ord AND t.planting_date IS NOT NULL GROUP BY t.aoi_id, h.row, h.col""",
    )
    step(
        f"windows_{tag}",
        f"""SELECT aoi_id, date,
  greatest(floor((52.0::DOUBLE - ymax) / {res}::DOUBLE), 0) AS row_lo,
  least(ceil((52.0::DOUBLE - ymin) / {res}::DOUBLE) - 1, {size} - 1) AS row_hi,
  greatest(floor((xmin - 4.5::DOUBLE) / {res}::DOUBLE), 0) AS col_lo,
  least(ceil((xmax - 4.5::DOUBLE) / {res}::DOUBLE) - 1, {size} - 1) AS col_hi
FROM (SELECT t.aoi_id, d.date, min(b.xmin) AS xmin, min(b.ymin) AS ymin, max(b.xmax) AS xmax, max(b.ymax) AS ymax
  FROM v_tagged t JOIN v_boxes b ON b.ord = t.ord JOIN v_days d ON t.planting_date <= d.date GROUP BY t.aoi_id, d.date)""",
    )
    step(
        f"mask_{tag}",
        f"""SELECT w.aoi_id, w.date, c.row, c.col FROM windows_{tag} w JOIN cells_{tag} c
  ON c.aoi_id = w.aoi_id AND c.planted <= w.date
WHERE w.row_hi - w.row_lo >= 1 AND w.col_hi - w.col_lo >= 1
UNION ALL
SELECT w.aoi_id, w.date, g.row, g.col FROM windows_{tag} w JOIN grid_{tag} g
  ON g.row BETWEEN w.row_lo AND w.row_hi AND g.col BETWEEN w.col_lo AND w.col_hi
WHERE w.row_hi - w.row_lo < 1 OR w.col_hi - w.col_lo < 1""",
    )


covered("fine", "0.02", 128)
covered("coarse", "0.64", 4)

step(
    "v_work",
    """
SELECT d.aoi_id, d.date, d.turn FROM v_aoi_days d JOIN (
  SELECT aoi_id, min(planting_date) AS first FROM v_tagged GROUP BY aoi_id) f
ON f.aoi_id = d.aoi_id AND f.first <= d.date
""",
)
RECORDS = f"""
SELECT r.aoi_id, r.date, r.turn, r.status, CASE WHEN r.status = 'ok' THEN m.mean_ndvi END AS mean_ndvi,
  CASE WHEN r.status = 'ok' THEN r.cloud_cover END AS cloud_cover,
  CASE WHEN r.status = 'ok' THEN r.item_datetime END AS item_datetime
FROM (SELECT w.aoi_id, w.date, w.turn, f.cloud_cover, f.item_datetime,
    CASE WHEN f.status <> 'ok' THEN 'no_satellite_item' WHEN ({EPSG}) IS NULL THEN 'missing_crs' ELSE 'ok' END AS status
  FROM v_work w JOIN v_refs f ON f.aoi_id = w.aoi_id AND f.date = w.date) r
LEFT JOIN (SELECT f.aoi_id, f.date, avg(n.ndvi) AS mean_ndvi FROM v_refs f
    JOIN mask_fine k ON k.aoi_id = f.aoi_id AND k.date = f.date
    JOIN v_ndvi n ON n.item_id = CAST(f.event_id % 4 AS VARCHAR) AND n.row = k.row AND n.col = k.col
  WHERE f.status = 'ok' GROUP BY f.aoi_id, f.date) m ON m.aoi_id = r.aoi_id AND m.date = r.date
"""
step("v_records", RECORDS)

# --- UTM grids ---------------------------------------------------------------------


def utm(lon: str, lat: str, middle: str) -> tuple[str, str]:
    """SQL for UTM x and y of degrees by the series in powers of the longitude difference."""
    e2 = float(E2)
    ep = repr(e2 / (1 - e2))
    arc = [1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256, 3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024]
    arc += [15 * e2**2 / 256 + 45 * e2**3 / 1024, 35 * e2**3 / 3072]
    p = f"radians({lat})"
    n = f"(6378137 / sqrt(1 - {E2}::DOUBLE * sin({p}) * sin({p})))"
    t, c = f"(tan({p}) * tan({p}))", f"({ep}::DOUBLE * cos({p}) * cos({p}))"
    a = f"(radians({lon} - {middle}) * cos({p}))"
    m = (
        f"(6378137 * ({arc[0]!r}::DOUBLE * {p} - {arc[1]!r}::DOUBLE * sin(2 * {p}) + "
        f"{arc[2]!r}::DOUBLE * sin(4 * {p}) - {arc[3]!r}::DOUBLE * sin(6 * {p})))"
    )
    x = (
        f"(500000 + 0.9996::DOUBLE * {n} * ({a} + (1 - {t} + {c}) * pow({a}, 3) / 6 + "
        f"(5 - 18 * {t} + {t} * {t} + 72 * {c} - 58 * {ep}::DOUBLE) * pow({a}, 5) / 120))"
    )
    y = (
        f"(0.9996::DOUBLE * ({m} + {n} * tan({p}) * (pow({a}, 2) / 2 + (5 - {t} + 9 * {c} + 4 * {c} * {c}) * pow({a}, 4) / 24 + "
        f"(61 - 58 * {t} + {t} * {t} + 600 * {c} - 330 * {ep}::DOUBLE) * pow({a}, 6) / 720)))"
    )
    return x, y


_ux, _uy = utm("lon", "lat", "middle")
step(
    "utm_vertices",
    f"""
SELECT z.epsg, z.x0, v.ord, v.k, {_ux} AS x, {_uy} AS y
FROM v_vertices v, (VALUES (32631, 3, 580000), (32632, 9, 150000), (32633, 15, -260000)) z(epsg, middle, x0)
""",
)
step(
    "utm_edges",
    """
SELECT a.epsg, a.ord, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
FROM utm_vertices a JOIN utm_vertices b ON a.ord = b.ord AND a.epsg = b.epsg AND b.k = (a.k + 1) % 4
""",
)
step(
    "utm_cells",
    """
SELECT h.epsg, t.aoi_id, h.row, h.col, min(t.planting_date) AS planted FROM (
  SELECT b.epsg, b.ord, g.row, g.col FROM (
    SELECT epsg, any_value(x0) AS x0, ord, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax
    FROM utm_vertices GROUP BY epsg, ord) b
  JOIN (SELECT r.row, c.col FROM range(128) r(row), range(128) c(col)) g
    ON b.x0 + (g.col + 0.5::DOUBLE) * 2000 BETWEEN b.xmin AND b.xmax
    AND 5800000 - (g.row + 0.5::DOUBLE) * 2000 BETWEEN b.ymin AND b.ymax
  JOIN utm_edges e ON e.ord = b.ord AND e.epsg = b.epsg
    AND least(e.y1, e.y2) <= 5800000 - (g.row + 0.5::DOUBLE) * 2000 AND 5800000 - (g.row + 0.5::DOUBLE) * 2000 < greatest(e.y1, e.y2)
    AND e.x1 + (5800000 - (g.row + 0.5::DOUBLE) * 2000 - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) <= b.x0 + (g.col + 0.5::DOUBLE) * 2000
  GROUP BY b.epsg, b.ord, g.row, g.col HAVING count(*) % 2 = 1) h
JOIN v_tagged t ON t.ord = h.ord AND t.planting_date IS NOT NULL GROUP BY h.epsg, t.aoi_id, h.row, h.col
""",
)
step(
    "utm_records",
    RECORDS.replace(
        "JOIN mask_fine k ON k.aoi_id = f.aoi_id AND k.date = f.date",
        f"JOIN utm_cells k ON k.aoi_id = f.aoi_id AND k.planted <= f.date AND k.epsg = {EPSG.replace('CASE k', 'CASE f.k')}",
    ),
)

# --- statements --------------------------------------------------------------------

ISO = "strftime({0}, '%Y-%m-%d') AS {0}"
STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f') AS {0}"
BOX = ", ".join(f"round({c}, 8) AS {c}" for c in ("minlon", "minlat", "maxlon", "maxlat"))
DATE = ISO.format("date")
RECORD = (
    f"aoi_id, {DATE}, status, round(mean_ndvi, 9) AS mean_ndvi, cloud_cover, "
    + STAMP.format("item_datetime")
)
URL = "CASE WHEN status = 'ok' THEN 'https://catalog.example/v1' END"
REF = (
    f"aoi_id, {DATE}, status, {BOX}, {STAMP.format('item_datetime')}, cloud_cover, "
    f"{URL} AS stac_url, collection, item_id, b04_asset, b08_asset"
)


def define(name: str, sql: str) -> None:
    SQL[name] = statement(sql)


define(
    "fields_scan",
    f"""
SELECT f.ord, f.field_id, {ISO.format('planting_date')}, 'crop ' || (f.ord % 7) AS crop, f.ord / 4 AS yield, CAST(5 AS BIGINT) AS n_vertices, round(b.xmin, 9) AS xmin,
  round(b.ymin, 9) AS ymin, round(b.xmax, 9) AS xmax, round(b.ymax, 9) AS ymax
FROM v_fields f JOIN v_boxes b ON b.ord = f.ord
""",
)
define(
    "fields_scan_split",
    f"""
SELECT row_number() OVER (ORDER BY f.ord) - 1 AS ord, f.field_id, {ISO.format('planting_date')}, round(b.xmin, 9) AS xmin,
  round(b.ymin, 9) AS ymin, round(b.xmax, 9) AS xmax, round(b.ymax, 9) AS ymax
FROM v_fields f JOIN v_boxes b ON b.ord = f.ord
""",
)
define(
    "fields_feature_json",
    """
SELECT 'Feature' AS type, f.ord, f.field_id, strftime(f.planting_date, '%Y-%m-%dT%H:%M:%S') AS planting_date,
  'Polygon' AS geometry_type, """
    + ", ".join(
        f"round(max(CASE WHEN v.k = {k % 4} THEN v.lon END), 9) AS lon{k}, "
        f"round(max(CASE WHEN v.k = {k % 4} THEN v.lat END), 9) AS lat{k}"
        for k in range(5)
    )
    + " FROM v_fields f JOIN v_vertices v ON v.ord = f.ord GROUP BY ALL",
)
_blon, _blat = unlaea("px", "py")
define(
    "crs_normalize",
    f"""
SELECT v.ord, CASE v.ord % 3 WHEN 1 THEN 'urn:ogc:def:crs:OGC:1.3:CRS84' WHEN 2 THEN 'EPSG:3035' END AS crs, v.k,
  round(CASE WHEN v.ord % 3 = 2 THEN {_blon} ELSE lon END, 8) AS lon,
  round(CASE WHEN v.ord % 3 = 2 THEN {_blat} ELSE lat END, 8) AS lat
FROM v_vertices v JOIN v_metres m ON m.ord = v.ord AND m.k = v.k
""",
)


def conformal() -> str:
    """x and y of degrees in each system, by the textbook formulas in t = tan(pi/4 - lat/2) over the ellipsoid's factor."""
    a, e2 = 6378137.0, float(E2)

    def t(p: float, e: float) -> float:
        return math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)

    def m(p: float) -> float:
        return math.cos(p) / math.sqrt(1 - e2 * math.sin(p) ** 2)

    def column(lat: str, e: float) -> str:
        es = f"{e!r}::DOUBLE * sin(radians({lat}))"
        return f"(tan(pi() / 4 - radians({lat}) / 2) / pow((1 - {es}) / (1 + {es}), {e / 2!r}::DOUBLE))"

    def conic(lon0: float, deg1: float, deg2: float, deg0: float, fe: float, fn: float) -> tuple[str, str]:
        p1, p2, p0 = map(math.radians, (deg1, deg2, deg0))
        e = math.sqrt(e2)
        n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1, e)) - math.log(t(p2, e)))
        f = a * m(p1) / (n * t(p1, e) ** n)
        r, angle = f"({f!r}::DOUBLE * pow({column('lat', e)}, {n!r}::DOUBLE))", f"({n!r}::DOUBLE * radians(lon - {lon0}))"
        return f"({fe} + {r} * sin({angle}))", f"({fn} + {f * t(p0, e) ** n!r}::DOUBLE - {r} * cos({angle}))"

    def polar(lon0: float, deg: float, south: bool) -> tuple[str, str]:
        e, p = math.sqrt(e2), math.radians(abs(deg))
        r = f"({a * m(p) / t(p, e)!r}::DOUBLE * {column('-lat' if south else 'lat', e)})"
        return f"({r} * sin(radians(lon - {lon0})))", f"({'' if south else '-'}{r} * cos(radians(lon - {lon0})))"

    east = f"({a} * radians(lon))"
    forms = {
        3857: (east, f"({a} * -ln({column('lat', 0.0)}))"),
        3395: (east, f"({a} * -ln({column('lat', math.sqrt(e2))}))"),
        2154: conic(3, 49, 44, 46.5, 700000, 6600000),
        3034: conic(10, 35, 65, 52, 4000000, 2800000),
        3413: polar(-45, 70, False),
        3031: polar(0, -71, True),
    }
    whens = [" ".join(f"WHEN {epsg} THEN {xy[i]}" for epsg, xy in forms.items()) for i in (0, 1)]
    number = "CASE ord % 6 " + " ".join(f"WHEN {i} THEN {epsg}" for i, epsg in enumerate(forms)) + " END"
    return f"""
SELECT ord, CAST(epsg AS INTEGER) AS epsg, k, round(CASE epsg {whens[0]} END, 3) AS x, round(CASE epsg {whens[1]} END, 3) AS y,
  round(lon, 8) AS lon, round(lat, 8) AS lat FROM (SELECT *, {number} AS epsg FROM v_vertices)
"""


define("crs_systems", conformal())
define("project_laea", "SELECT ord, k, round(px, 3) AS x, round(py, 3) AS y FROM v_metres")
define(
    "unproject_laea",
    f"SELECT ord, k, round({_lon}, 8) AS lon, round({_lat}, 8) AS lat "
    "FROM (SELECT ord, k, round(px, 3) AS x, round(py, 3) AS y FROM v_metres)",
)
define("centroids", "SELECT ord, x, y FROM v_centroids")
define("nn_distance", "SELECT ord, round(nn_dist, 6) AS nn_dist FROM v_nearest")
define("eps_estimate", "SELECT round(eps, 6) AS eps FROM v_eps")
define("eps_pairs", "SELECT a, b, round(dist, 6) AS dist FROM v_pairs WHERE a < b")
define("dbscan_labels", "SELECT ord, label, cluster FROM clusters_m2")
define("dbscan_min5", "SELECT ord, label, cluster FROM clusters_m5")
define("dbscan_all_noise", "SELECT ord, label, cluster FROM clusters_m2far")
define("aois", f"SELECT aoi_id, {BOX} FROM v_aois")
define("fields_with_aoi", f"SELECT ord, field_id, {ISO.format('planting_date')}, aoi_id FROM v_tagged")
define("aoi_roundtrip", f"SELECT aoi_id, {BOX} FROM v_aois")
define("day_range", f"SELECT {DATE} FROM v_days")
define("aoi_days", f"SELECT aoi_id, {DATE} FROM v_aoi_days")
define(
    "scenes_scan",
    f"""
SELECT item_id, 'sentinel-2-l2a' AS collection, {STAMP.format('dt')}, cloud_cover,
  CAST(CASE WHEN k = 0 THEN 32632 END AS BIGINT) AS proj_epsg, round(xmin, 6) AS xmin, round(ymin, 6) AS ymin,
  round(xmax, 6) AS xmax, round(ymax, 6) AS ymax, coalesce(b04_asset || ',' || b08_asset, 'B02') AS asset_keys
FROM (SELECT * REPLACE (CASE WHEN b04_asset = 'red' THEN 'nir' ELSE b04_asset END AS b04_asset,
  CASE WHEN b04_asset = 'red' THEN 'red' ELSE b08_asset END AS b08_asset) FROM v_scenes)
""",
)
define(
    "scenes_search",
    f"""
SELECT item_id, {STAMP.format('dt')}, cloud_cover, round(xmin, 9) AS xmin, round(ymin, 9) AS ymin, round(xmax, 9) AS xmax, round(ymax, 9) AS ymax
FROM v_scenes WHERE xmin <= 5.85::DOUBLE AND xmax >= 5.25::DOUBLE AND ymin <= 50.35::DOUBLE AND ymax >= 50.05::DOUBLE
  AND dt >= TIMESTAMP '2024-01-05' AND dt < TIMESTAMP '2024-01-10' AND cloud_cover < 30
""",
)
define("scene_candidates", f"SELECT aoi_id, item_id, {DATE} FROM v_candidates")
define("best_scene", f"SELECT aoi_id, {DATE}, item_id, {STAMP.format('dt')}, cloud_cover FROM v_best")
define(
    "scene_topk",
    f"""
SELECT aoi_id, {DATE}, rank, item_id FROM (SELECT aoi_id, date, item_id,
  row_number() OVER (PARTITION BY aoi_id, date ORDER BY cloud_cover, dt, item_id) AS rank FROM v_candidates)
WHERE rank <= 3
""",
)
define(
    "scene_topk_closed_second",
    f"""
SELECT aoi_id, {DATE}, count(*) AS n FROM v_candidates
WHERE dt <= CAST(dt AS DATE) + INTERVAL 86399 SECOND GROUP BY aoi_id, date
""",
)
define("scene_refs", f"SELECT {REF} FROM v_refs")
define("stream_scene_days", f"SELECT {REF} FROM v_refs")
define(
    "ref_scene_lookup",
    f"""
SELECT aoi_id, {DATE}, item_id, {STAMP.format('item_datetime').replace('AS item_datetime', 'AS dt')}, cloud_cover,
  CAST(CASE WHEN k = 0 THEN 32632 END AS BIGINT) AS proj_epsg
FROM v_refs WHERE status = 'ok'
""",
)
define("refs_sink_roundtrip", f"SELECT {REF} FROM v_refs")
define("pick_assets", "SELECT item_id, b04_asset, b08_asset FROM v_scenes")
define(
    "pick_epsg",
    f"""
SELECT item_id, CAST(CASE WHEN k = 0 THEN 32632 WHEN event_type = 'error' THEN NULL ELSE {EPSG} END AS BIGINT) AS epsg
FROM v_scenes
""",
)
define("incremental_days", f"SELECT DISTINCT {DATE} FROM v_aoi_days WHERE turn % 3 <> 0")
define("incremental_refs", f"SELECT aoi_id, {DATE}, status, item_id FROM v_refs WHERE turn % 3 <> 0")
define("incremental_ndvi", f"SELECT aoi_id, {DATE} FROM v_work WHERE turn % 3 <> 0 AND turn % 5 <> 0")
define(
    "pixel_scan",
    """
SELECT item_id, 'red' AS band, row, col,
  row_number() OVER (PARTITION BY item_id, row, col
    ORDER BY obs_order, obs_line, coalesce(red_raw, -9999), coalesce(nir_raw, -9999)) - 1 AS layer,
  coalesce(red_raw, -9999) AS raw FROM v_pixels
WHERE row BETWEEN 10 AND 90 AND col BETWEEN 20 AND 100
""",
)
define(
    "pixel_rescale",
    """
SELECT item_id, row, col, obs_order, obs_line, band, round(raw * 0.0001::DOUBLE, 6) AS value FROM (
  SELECT item_id, row, col, obs_order, obs_line, 'red' AS band, red_raw AS raw FROM v_pixels UNION ALL
  SELECT item_id, row, col, obs_order, obs_line, 'nir', nir_raw FROM v_pixels)
""",
)
define(
    "pixel_world_coords",
    """
SELECT DISTINCT item_id, row, col, round(4.5::DOUBLE + (col + 0.5::DOUBLE) * 0.02::DOUBLE, 6) AS x,
  round(52.0::DOUBLE - (row + 0.5::DOUBLE) * 0.02::DOUBLE, 6) AS y FROM v_pixels
""",
)
define(
    "ndvi_pixels",
    "SELECT item_id, row, col, obs_order, obs_line, round(red, 6) AS red, round(nir, 6) AS nir, "
    "round(ndvi, 9) AS ndvi FROM v_ndvi",
)
define(
    "eligible_fields",
    f"SELECT ord, field_id, aoi_id, {ISO.format('planting_date')} FROM v_tagged "
    "WHERE planting_date <= DATE '2024-01-15'",
)
define(
    "eligible_bounds",
    """
SELECT t.aoi_id, round(min(b.xmin), 9) AS xmin, round(min(b.ymin), 9) AS ymin, round(max(b.xmax), 9) AS xmax,
  round(max(b.ymax), 9) AS ymax
FROM v_tagged t JOIN v_boxes b ON b.ord = t.ord WHERE t.planting_date <= DATE '2024-01-15' GROUP BY t.aoi_id
""",
)
# the union of an area's fields, cut into slabs in which no two edges cross
step(
    "u_planted",
    """
SELECT aoi_id, ord FROM v_tagged WHERE aoi_id IS NOT NULL AND planting_date <= DATE '2024-01-15'
""",
)
step(
    "u_lines",
    """
SELECT p.aoi_id, e.* FROM u_planted p JOIN v_edges e ON e.ord = p.ord
""",
)
step(
    "u_breaks",
    """
SELECT aoi_id, y1 AS y FROM u_lines
  UNION
  SELECT aoi_id, ay + t * (by_ - ay) FROM (
    SELECT a.aoi_id, a.y1 AS ay, a.y2 AS by_,
      ((c.x1 - a.x1) * (c.y2 - c.y1) - (c.y1 - a.y1) * (c.x2 - c.x1)) / ((a.x2 - a.x1) * (c.y2 - c.y1) - (a.y2 - a.y1) * (c.x2 - c.x1)) AS t
    FROM u_lines a JOIN u_lines c ON a.aoi_id = c.aoi_id AND a.ord < c.ord AND (a.x2 - a.x1) * (c.y2 - c.y1) - (a.y2 - a.y1) * (c.x2 - c.x1) <> 0
      AND least(a.x1, a.x2) <= greatest(c.x1, c.x2) AND greatest(a.x1, a.x2) >= least(c.x1, c.x2)
      AND least(a.y1, a.y2) <= greatest(c.y1, c.y2) AND greatest(a.y1, a.y2) >= least(c.y1, c.y2)) WHERE t BETWEEN 0 AND 1
""",
)
step(
    "u_slabs",
    """
SELECT aoi_id, y AS lo, lead(y) OVER (PARTITION BY aoi_id ORDER BY y) AS hi FROM u_breaks
""",
)
step(
    "u_spans",
    """
SELECT s.aoi_id, s.lo, s.hi, l.ord, min(l.x1 + (m - l.y1) * (l.x2 - l.x1) / (l.y2 - l.y1)) AS a, max(l.x1 + (m - l.y1) * (l.x2 - l.x1) / (l.y2 - l.y1)) AS b
  FROM (SELECT *, (lo + hi) / 2 AS m FROM u_slabs WHERE hi > lo) s
  JOIN u_lines l ON l.aoi_id = s.aoi_id AND least(l.y1, l.y2) <= m AND m < greatest(l.y1, l.y2) GROUP BY ALL
""",
)
step(
    "u_reached",
    """
SELECT *, max(b) OVER (PARTITION BY aoi_id, lo ORDER BY a, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM u_spans
""",
)
step(
    "u_areas",
    """
SELECT aoi_id, sum((hi - lo) * greatest(0, b - greatest(a, coalesce(before, a)))) AS area FROM u_reached GROUP BY aoi_id
""",
)
define(
    "union_polygons",
    """
SELECT aoi_id, round(any_value(area), 9) AS area, round(min(least(x1, x2)), 8) AS xmin, round(min(least(y1, y2)), 8) AS ymin,
  round(max(greatest(x1, x2)), 8) AS xmax, round(max(greatest(y1, y2)), 8) AS ymax
FROM u_areas JOIN u_lines USING (aoi_id) GROUP BY aoi_id
""",
)
define(
    "union_spans",
    """
SELECT aoi_id, grid_id, row, min(col) AS lo, max(col) AS hi FROM (
  SELECT aoi_id, row, col, col - row_number() OVER (PARTITION BY aoi_id, row ORDER BY col) AS island
  FROM cells_fine WHERE planted <= DATE '2024-01-15') r, (SELECT DISTINCT item_id AS grid_id FROM v_pixels) g
GROUP BY aoi_id, grid_id, row, island
""",
)
for _name, _tag, _size in (("pixel_mask", "fine", 1), ("pixel_mask_tiny", "coarse", 32)):
    define(
        _name,
        f"""
SELECT m.aoi_id, p.item_id, m.row, m.col, count(*) AS n FROM mask_{_tag} m
JOIN v_pixels p ON p.row // {_size} = m.row AND p.col // {_size} = m.col
WHERE m.date = DATE '2024-01-15' GROUP BY m.aoi_id, p.item_id, m.row, m.col
""",
    )
define(
    "pixel_mask_strict",
    """
SELECT c.aoi_id, p.item_id, c.row, c.col, count(*) AS n FROM cells_coarse c
JOIN v_pixels p ON p.row // 32 = c.row AND p.col // 32 = c.col
WHERE c.planted <= DATE '2024-01-15' GROUP BY c.aoi_id, p.item_id, c.row, c.col
""",
)
define(
    "ndvi_status",
    f"""
SELECT w.aoi_id, strftime(w.date, '%Y-%m-%d') AS date, CASE WHEN coalesce(f.status, 'none') <> 'ok' THEN 'no_satellite_item'
  WHEN ({EPSG}) IS NULL THEN 'missing_crs' ELSE 'ok' END AS status,
  CAST(CASE WHEN f.status = 'ok' THEN ({EPSG}) END AS BIGINT) AS epsg
FROM v_work w LEFT JOIN (SELECT * FROM v_refs WHERE turn % 5 <> 0) f ON f.aoi_id = w.aoi_id AND f.date = w.date
""",
)
define("ndvi_utm", f"SELECT {RECORD} FROM utm_records")
define(
    "pixel_mask_utm",
    """
SELECT aoi_id, CAST(epsg AS VARCHAR) AS grid_id, row, min(col) AS lo, max(col) AS hi FROM (
  SELECT epsg, aoi_id, row, col, col - row_number() OVER (PARTITION BY epsg, aoi_id, row ORDER BY col) AS island
  FROM utm_cells WHERE planted <= DATE '2024-01-15')
GROUP BY epsg, aoi_id, row, island
""",
)
define("ndvi_by_aoi_day", f"SELECT {RECORD} FROM v_records")
define("ndvi_from_strips", f"SELECT {RECORD} FROM v_records")
define(
    "ndvi_strip_widths",
    f"SELECT strips, {RECORD} FROM v_records, unnest(['300', '512', '1024', '100 from 37']) w(strips)",
)
# the brightest value of each cell, near infrared by blocks of two cells a side
step(
    "x_red",
    """
SELECT item_id, row, col, max(red_raw) AS raw FROM v_pixels GROUP BY item_id, row, col
""",
)
step(
    "x_nir",
    """
SELECT item_id, row // 2 AS row, col // 2 AS col, max(nir_raw) AS raw FROM v_pixels GROUP BY item_id, row // 2, col // 2
""",
)
step(
    "x_ndvi",
    """
SELECT r.item_id, r.row, r.col, CASE WHEN n.raw + r.raw <> 0 THEN (n.raw * 0.0001::DOUBLE - r.raw * 0.0001::DOUBLE)
  / (n.raw * 0.0001::DOUBLE + r.raw * 0.0001::DOUBLE) END AS ndvi
FROM x_red r JOIN x_nir n ON n.item_id = r.item_id AND n.row = r.row // 2 AND n.col = r.col // 2
""",
)
step("x_records", re.sub(r"\bv_ndvi\b", "x_ndvi", RECORDS))
define("ndvi_mixed_resolution", f"SELECT {RECORD} FROM x_records")
# lengths that cells of the two grids share along either axis, in degrees
step(
    "x_across",
    """
SELECT * FROM (SELECT t.c, f.i, least(4.513::DOUBLE + (t.c + 1) * 0.05::DOUBLE, 4.5::DOUBLE + (f.i + 1) * 0.02::DOUBLE)
  - greatest(4.513::DOUBLE + t.c * 0.05::DOUBLE, 4.5::DOUBLE + f.i * 0.02::DOUBLE) AS w FROM range(50) t(c), range(128) f(i)) WHERE w > 1e-10
""",
)
step(
    "x_down",
    """
SELECT * FROM (SELECT t.c, f.i, least(t.c * 0.03::DOUBLE + 0.039::DOUBLE, (f.i + 1) * 0.02::DOUBLE)
  - greatest(t.c * 0.03::DOUBLE + 0.009::DOUBLE, f.i * 0.02::DOUBLE) AS w FROM range(80) t(c), range(128) f(i)) WHERE w > 1e-10
""",
)
step(
    "x_fine",
    """
SELECT item_id, row, col, max(nir_raw) AS raw FROM v_pixels GROUP BY item_id, row, col HAVING max(nir_raw) IS NOT NULL
""",
)
define(
    "raster_resample_mean",
    """
SELECT 'half' AS grid, item_id, row // 2 AS row, col // 2 AS col, round(avg(raw), 6) AS value FROM x_fine GROUP BY ALL
UNION ALL
SELECT 'uneven', p.item_id, y.c, x.c, round(sum(p.raw * x.w * y.w) / sum(x.w * y.w), 6)
FROM x_fine p JOIN x_across x ON x.i = p.col JOIN x_down y ON y.i = p.row GROUP BY p.item_id, y.c, x.c
""",
)
define("ndvi_sink_roundtrip", f"SELECT {RECORD} FROM v_records")
define(
    "stage_manifest",
    """
SELECT 'processed' AS processed_bucket, 'derived/' AS derived_out_prefix, 'ingest/' AS ingest_out_prefix,
  'calculation/' AS calc_out_prefix, 's3://processed/derived/aois.json' AS aois_json_s3,
  's3://processed/derived/fields_with_aoi.geojson' AS fields_with_aoi_s3,
  (SELECT count(*) FROM v_aois) AS aois_count,
  (SELECT 's3://processed/calculation/aoi_timeseries/date=' || strftime(date, '%Y-%m-%d') || '/aoi_id=' || aoi_id || '/ndvi.json'
    FROM v_records ORDER BY aoi_id, date LIMIT 1) AS first_result
""",
)
define("uri_split", "SELECT doc_id, lang AS bucket, source || '/' || doc_id || '.json' AS key FROM documents")
define(
    "partition_paths",
    """
SELECT aoi_id, strftime(date, '%Y-%m-%d') AS date,
  'ingest/aoi_id=' || aoi_id || '/date=' || strftime(date, '%Y-%m-%d') || '/s2_refs.json' AS ref_path,
  'calculation/aoi_timeseries/date=' || strftime(date, '%Y-%m-%d') || '/aoi_id=' || aoi_id || '/ndvi.json' AS ndvi_path
FROM v_aoi_days
""",
)
define(
    "stream_scene_refs",
    f"SELECT aoi_id, {DATE}, status, item_id, cloud_cover, {URL} AS stac_url FROM v_refs WHERE status = 'ok'",
)
define("stream_ndvi", f"SELECT {RECORD} FROM v_records")
