"""The same distance formulas as SQL text for the check engine."""

from __future__ import annotations


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(power(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) "
        f"* power(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(2 * 6371000e0 * atan2(sqrt({a}), sqrt(1 - {a})))"


def geodesic_stages(source: str, lat1: str, lon1: str, lat2: str, lon2: str, carry: str, steps: int = 8) -> str:
    """CTEs that end in ``geo_out(carry..., km)``: Vincenty's inverse series, one CTE per step."""
    f = "(1 / 298.257223563e0)"
    keep = ", ".join(c.strip() for c in carry.split(","))
    out = [
        f"geo_u AS (SELECT {keep}, atan((1 - {f}) * tan(radians({lat1}))) AS u1, atan((1 - {f}) * tan(radians({lat2}))) AS u2, radians({lon2} - {lon1}) AS big FROM {source})",
        f"geo_0 AS (SELECT {keep}, sin(u1) AS s1, cos(u1) AS c1, sin(u2) AS s2, cos(u2) AS c2, big, big AS lam, 0e0 AS ss, 1e0 AS cs, 0e0 AS sg, 0e0 AS ca, 0e0 AS m FROM geo_u)",
    ]
    for k in range(steps):
        out.append(
            f"geo_a{k} AS (SELECT {keep}, s1, c1, s2, c2, big, lam, sqrt(power(c2 * sin(lam), 2) + power(c1 * s2 - s1 * c2 * cos(lam), 2)) AS ss, "
            f"s1 * s2 + c1 * c2 * cos(lam) AS cs FROM geo_{k})"
        )
        out.append(f"geo_b{k} AS (SELECT *, atan2(ss, cs) AS sg, CASE WHEN ss = 0 THEN 0 ELSE c1 * c2 * sin(lam) / ss END AS sa FROM geo_a{k})")
        out.append(f"geo_c{k} AS (SELECT *, 1 - sa * sa AS ca, CASE WHEN 1 - sa * sa = 0 THEN 0 ELSE cs - 2 * s1 * s2 / (1 - sa * sa) END AS m FROM geo_b{k})")
        out.append(f"geo_d{k} AS (SELECT *, {f} / 16 * ca * (4 + {f} * (4 - 3 * ca)) AS cc FROM geo_c{k})")
        out.append(
            f"geo_{k + 1} AS (SELECT {keep}, s1, c1, s2, c2, big, big + (1 - cc) * {f} * sa * (sg + cc * ss * (m + cc * cs * (2 * m * m - 1))) AS lam, ss, cs, sg, ca, m FROM geo_d{k})"
        )
    out.append(f"geo_k AS (SELECT *, ca * (1 / power(1 - {f}, 2) - 1) AS k2 FROM geo_{steps})")
    out.append(
        "geo_ab AS (SELECT *, 1 + k2 / 16384 * (4096 + k2 * (-768 + k2 * (320 - 175 * k2))) AS aa, k2 / 1024 * (256 + k2 * (-128 + k2 * (74 - 47 * k2))) AS bb FROM geo_k)"
    )
    out.append(
        f"geo_out AS (SELECT {keep}, 6378.137e0 * (1 - {f}) * aa * (sg - bb * ss * (m + bb / 4 * (cs * (2 * m * m - 1) "
        "- bb / 6 * m * (4 * ss * ss - 3) * (4 * m * m - 3)))) AS km FROM geo_ab)"
    )
    return ",\n".join(out)
