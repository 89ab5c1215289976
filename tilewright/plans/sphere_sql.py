"""SQL texts of the projection formulas, for the comparison queries."""

R = 1737400.0


def inverse(x: str, y: str) -> tuple[str, str]:
    """(latitude, longitude) expressions over the columns kind, lat0, lon0, k0, fe, fn."""
    k, s = f"(k0 * {R})", "(CASE WHEN lat0 < 0 THEN 1e0 ELSE -1e0 END)"
    dx, dy = f"(({x}) - fe)", f"(({y}) - fn)"
    d = f"({dy} / {k} + radians(lat0))"
    c = f"(2 * atan(sqrt({dx} * {dx} + {dy} * {dy}) / (2 * {k})))"
    lat = f"degrees(CASE WHEN kind = 'ps' THEN {s} * ({c} - pi() / 2) ELSE asin(sin({d}) / cosh({dx} / {k})) END)"
    lon = f"(degrees(CASE WHEN kind = 'ps' AND {dx} = 0 AND {dy} = 0 THEN 0e0 WHEN kind = 'ps' THEN atan2({dx}, {s} * {dy}) ELSE atan2(sinh({dx} / {k}), cos({d})) END) + lon0)"
    return lat, f"((({lon} + 180) % 360 + 360) % 360 - 180)"


def forward(lat: str, lon: str) -> tuple[str, str]:
    k, s = f"(k0 * {R})", "(CASE WHEN lat0 < 0 THEN 1e0 ELSE -1e0 END)"
    p, m = f"radians({lat})", f"radians(({lon}) - lon0)"
    rho, b = f"(2 * {k} * tan(pi() / 4 + {s} * {p} / 2))", f"(cos({p}) * sin({m}))"
    return (f"(CASE WHEN kind = 'ps' THEN fe + {rho} * sin({m}) ELSE fe + {k} / 2 * ln((1 + {b}) / (1 - {b})) END)",
            f"(CASE WHEN kind = 'ps' THEN fn + {s} * {rho} * cos({m}) ELSE fn + {k} * (atan2(tan({p}), cos({m})) - radians(lat0)) END)")


def scale(lat: str, lon: str) -> str:
    return f"(CASE WHEN kind = 'ps' THEN k0 * 2 / (1 + sin(abs(radians({lat})))) ELSE k0 / sqrt(1 - pow(cos(radians({lat})) * sin(radians(({lon}) - lon0)), 2)) END)"


def distance(a: str, b: str, c: str, d: str) -> str:
    h = f"(pow(sin((radians({c}) - radians({a})) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians(({d}) - ({b})) / 2), 2))"
    return f"(2 * {R} * asin(sqrt(least(greatest({h}, 0e0), 1e0))))"


LAT, LON = inverse("x_min + (x + w / 2) * px", "y_max - (y + h / 2) * px")
#: Detections of at least the display confidence with coordinates and size.
LOCATED = f"""located AS (SELECT *, (w + h) / 2 * (px / {scale('lat', 'lon')}) / 1000 AS diameter_km, CASE WHEN x <= 0 OR y <= 0 OR x + w >= width OR y + h >= width THEN 1 ELSE 0 END AS truncated
  FROM (SELECT d.*, t.* EXCLUDE (tile_id), {LAT} AS lat, {LON} AS lon FROM det d JOIN tile t ON t.tile_id = d.tile_id WHERE d.score >= 0.5))"""
_CLAT, _CLON = inverse("x_min + width / 2 * px", "y_max - width / 2 * px")
CENTER = f"center AS (SELECT *, px / {scale('lat', 'lon')} AS ground_m FROM (SELECT *, {_CLAT} AS lat, {_CLON} AS lon FROM tile))"
PAIRS = """pairs AS (SELECT tile_id, det, ref, score, inter / (w * h + rw * rh - inter) AS iou FROM (
  SELECT d.tile_id, d.idx AS det, r.idx AS ref, d.score, d.w, d.h, r.w AS rw, r.h AS rh, (least(d.x + d.w, r.x + r.w) - greatest(d.x, r.x)) * (least(d.y + d.h, r.y + r.h) - greatest(d.y, r.y)) AS inter
  FROM det d JOIN ref r ON d.tile_id = r.tile_id AND d.x < r.x + r.w AND r.x < d.x + d.w AND d.y < r.y + r.h AND r.y < d.y + d.h {where}) WHERE inter / (w * h + rw * rh - inter) >= 0.5)"""
MATCHES = """ord AS (SELECT tile_id, thr, det, list({'iou': iou, 'ref': ref} ORDER BY iou DESC, ref DESC) AS c, row_number() OVER (PARTITION BY tile_id, thr ORDER BY score DESC, det) AS k FROM pairs, (SELECT unnest(LEVELS) AS thr) WHERE iou >= thr GROUP BY tile_id, thr, det, score),
walk(tile_id, thr, k, taken, det, p) AS (
  SELECT tile_id, thr, k, [c[1].ref], det, c[1] FROM ord WHERE k = 1
  UNION ALL
  SELECT tile_id, thr, k, CASE WHEN p IS NULL THEN taken ELSE list_append(taken, p.ref) END, det, p FROM (
    SELECT o.tile_id, o.thr, o.k, w.taken, o.det, list_filter(o.c, lambda q: NOT list_contains(w.taken, q.ref))[1] AS p FROM walk w JOIN ord o ON o.tile_id = w.tile_id AND o.thr = w.thr AND o.k = w.k + 1)),
matches AS (SELECT tile_id, thr, det, p.ref AS ref, p.iou AS iou FROM walk WHERE p IS NOT NULL)"""


def matches(levels=(0.5,)) -> str:
    return MATCHES.replace("LEVELS", str([float(x) for x in levels]))
