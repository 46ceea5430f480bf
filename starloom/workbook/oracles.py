"""DuckDB SQL that says what each registered query must return.

Written from the definitions, in the plainest form: pixel joins, cross joins and windows
where the library has something better. Numbers are written with an exponent (``1.4e0``), since
DuckDB reads ``1.4`` as a decimal and not as a double.
"""

from __future__ import annotations

# --- sky tables -----------------------------------------------------------------------


def _scatter(k: str, factor: int, modulus: int, start: int) -> str:
    return f"({start} + (({k}) % {modulus}) * {factor} % {modulus})"


def _position(k: str, wide: bool, shift: int = 0) -> tuple[str, str]:
    if wide:
        ra, dec = _scatter(k, 87178291, 3599900009, 20000), _scatter(k, 39916801, 1790000003, -895000000)
        dec = f"({dec} + CASE WHEN {dec} >= 0 THEN 100000 ELSE -100000 END)"
    else:
        ra, dec = _scatter(k, 87178291, 360000007, 100000000), _scatter(k, 39916801, 160000003, 120000000)
    return f"({ra} + {shift}) / 1e7", f"({dec} - {shift}) / 1e7"


def stars(wide: bool = False, observation: int = 1) -> str:
    ra, dec = _position("o_orderkey", wide)
    second = observation == 2
    bump = 1 if second else 0
    day = "CAST(o_orderdate AS DATE)"
    if second:
        day += " + CAST(o_orderkey % 7 - 3 AS INTEGER)"
    source = "CASE WHEN o_orderkey % 53 <> 0 THEN o_orderkey END" if second else "o_orderkey"
    return f"""(SELECT source_id, ra, dec, parallax, parallax_error, pmra, pmdec, ruwe, phot_g_mean_mag,
      phot_bp_mean_mag, phot_rp_mean_mag, CAST(j AS FLOAT) AS j_m, CAST(h AS FLOAT) AS h_m,
      CAST(h - (k % 30) / 1e2 AS FLOAT) AS ks_m, CAST(year(d) AS INTEGER) AS year,
      CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day FROM (
        SELECT *, j - (k % 70) / 1e2 AS h FROM (
          SELECT o_orderkey AS k, {source} AS source_id, {ra} AS ra, {dec} AS dec,
            CASE WHEN o_orderkey % 97 <> 0 THEN (o_orderkey * 31 % 400 - 50 + {bump}) / 1e1 END AS parallax,
            5e-2 + (o_orderkey % 20) / 2e1 AS parallax_error,
            CASE WHEN o_orderkey % 101 = 0 THEN CAST('nan' AS DOUBLE) WHEN o_orderkey % 17 <> 0 THEN (o_orderkey * 13 % 2001 - 1000 + {bump}) / 1e1 END AS pmra,
            CASE WHEN o_orderkey % 19 <> 0 THEN (o_orderkey * 11 % 2001 - 1000) / 1e1 END AS pmdec,
            8e-1 + (o_orderkey % 15) / 1e1 AS ruwe,
            8 + (o_orderkey % 1200) / 1e2 AS phot_g_mean_mag,
            9 + (o_orderkey % 1100) / 1e2 AS phot_bp_mean_mag,
            7 + (o_orderkey % 1300) / 1e2 AS phot_rp_mean_mag,
            5 + (o_custkey % 1000) / 1e2 AS j, {day} AS d FROM orders)))"""


def objects(wide: bool = False) -> str:
    def rows(name: str, key: str, year: str, shift: int) -> str:
        ra, dec = _position(f"{key} * 10", wide, shift)
        return f"""SELECT '  C' || {key} || ' ' AS main_id, {ra} AS ra_deg, {dec} AS dec_deg,
          CAST({year} + {key} % 3 AS INTEGER) AS year, CAST(1 + {key} % 12 AS INTEGER) AS month,
          CAST(1 + {key} % 28 AS INTEGER) AS day FROM {name}"""

    first, later = rows("customer", "c_custkey", "2019", 1000), rows("supplier", "s_suppkey", "2020", 500)
    return f"({first} UNION ALL {later})"


def centers(wide: bool = False) -> str:
    ra, dec = _position("c_custkey * 10", wide, 1000)
    return f"(SELECT 'C' || c_custkey AS main_id, {ra} AS ra, {dec} AS dec FROM customer)"


NEIGHBOURS = "(SELECT l_orderkey AS source_id, l_partkey AS oid, l_discount AS angular_distance FROM lineitem)"
BRIDGE = "(SELECT p_partkey AS oid, 'T' || CAST(floor(p_partkey / 16e0) AS BIGINT) AS designation FROM part)"
INFRARED = """(SELECT 'T' || s_suppkey AS designation, CAST(j AS FLOAT) AS j_m, CAST(j - 25e-2 AS FLOAT) AS h_m,
  CAST(j - 5e-1 AS FLOAT) AS ks_m FROM (SELECT s_suppkey, 5 + (s_suppkey % 700) / 1e2 AS j FROM supplier))"""

_P_RA, _P_DEC = _position("p_partkey", True)
PLANETS = f"""(SELECT p_name AS pl_name, CASE WHEN p_partkey % 11 <> 0 THEN p_retailprice END AS pl_masse,
  p_brand AS hostname, {_P_RA} AS ra, {_P_DEC} AS dec, 'G ' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS gaia_dr3_id,
  CAST(1 + p_partkey % 3 AS INTEGER) AS sy_snum, CAST(p_partkey % 2 AS INTEGER) AS sy_mnum,
  CAST(p_size AS INTEGER) AS sy_pnum, p_type AS soltype,
  CASE WHEN p_partkey % 7 <> 0 THEN 'Transit' END AS discoverymethod,
  CASE WHEN p_partkey % 13 <> 0 THEN CAST(1995 + p_partkey % 30 AS INTEGER) END AS disc_year,
  'Ground' AS disc_locale, 'Telescope ' || p_size AS disc_telescope, CAST(p_partkey % 2 AS INTEGER) AS obm_flag,
  CAST(p_partkey % 5 AS INTEGER) AS micro_flag, '2024-01-01' AS releasedate,
  CAST(p_partkey % 360 AS DOUBLE) AS elon, CAST(p_partkey % 90 AS DOUBLE) AS elat FROM part)"""


# --- formulas -------------------------------------------------------------------------


def healpix(source: str, ra: str = "ra", dec: str = "dec", depth: int = 6, out: str = "healpix_index") -> str:
    """``source`` with the nested pixel number added as ``out``."""
    n = 1 << depth
    bits = " + ".join(f"(((ix >> {b}) & 1) << {2 * b}) + (((iy >> {b}) & 1) << {2 * b + 1})" for b in range(depth))
    return f"""(SELECT * EXCLUDE (t, z, w, q, s, jp, jm, fp, fm, face, ix, iy), face * {n * n} + {bits} AS {out} FROM (
      SELECT *,
        CASE WHEN abs(z) <= 2e0 / 3e0 THEN
               CASE WHEN fp = fm THEN (fp & 3) | 4 WHEN fp < fm THEN fp & 3 ELSE (fm & 3) + 8 END
             WHEN z > 0 THEN q ELSE q + 8 END AS face,
        CASE WHEN abs(z) <= 2e0 / 3e0 THEN jm % {n} WHEN z > 0 THEN {n - 1} - jm ELSE jp END AS ix,
        CASE WHEN abs(z) <= 2e0 / 3e0 THEN {n - 1} - jp % {n} WHEN z > 0 THEN {n - 1} - jp ELSE jm END AS iy FROM (
        SELECT *, jp // {n} AS fp, jm // {n} AS fm FROM (
          SELECT *,
            CAST(CASE WHEN abs(z) <= 2e0 / 3e0 THEN floor({n}e0 * (t + 5e-1) - {0.75 * n} * z)
                 ELSE least({n - 1}, floor(s * w)) END AS BIGINT) AS jp,
            CAST(CASE WHEN abs(z) <= 2e0 / 3e0 THEN floor({n}e0 * (t + 5e-1) + {0.75 * n} * z)
                 ELSE least({n - 1}, floor((1 - s) * w)) END AS BIGINT) AS jm FROM (
            SELECT *, CAST(floor(t) AS BIGINT) AS q, t - floor(t) AS s FROM (
              SELECT *, ({ra} - 360 * floor({ra} / 36e1)) / 9e1 AS t, sin(radians({dec})) AS z,
                {n} * sqrt(6e0) * sin(radians(9e1 - abs({dec})) / 2) AS w FROM {source}))))))"""


def _unit(ra: str, dec: str) -> tuple[str, str, str]:
    return (
        f"cos(radians({ra})) * cos(radians({dec}))",
        f"cos(radians({dec})) * sin(radians({ra}))",
        f"sin(radians({dec}))",
    )


def _flat(ra_l: str, dec_l: str, ra_r: str, dec_r: str) -> str:
    return f"sqrt(pow((({ra_l}) - ({ra_r})) * cos(radians({dec_l})), 2) + pow(({dec_l}) - ({dec_r}), 2))"


def _great_circle(ra_l: str, dec_l: str, ra_r: str, dec_r: str) -> str:
    return (
        f"degrees(2 * asin(sqrt(least(1e0, pow(sin(radians(({dec_l}) - ({dec_r})) / 2), 2)"
        f" + cos(radians({dec_l})) * cos(radians({dec_r})) * pow(sin(radians(({ra_l}) - ({ra_r})) / 2), 2)))))"
    )


def _chord2(a: tuple[str, str], b: tuple[str, str]) -> str:
    return " + ".join(f"pow({p} - {q}, 2)" for p, q in zip(_unit(*a), _unit(*b)))


_STEP = "(16e0 * (1e0 / 3.6e6))"


def _moved(ra: str, dec: str, pmra: str, pmdec: str) -> tuple[str, str]:
    return (
        f"{ra} + coalesce({pmra}, 0) * {_STEP} / cos(radians({dec}))",
        f"{dec} + coalesce({pmdec}, 0) * {_STEP}",
    )


def _chord_limit(degrees: float) -> str:
    return f"pow(2 * sin(radians({degrees}e0) / 2), 2)"


_RELIABLE = "(parallax > 0 AND CASE WHEN parallax <> 0 THEN parallax_error / parallax END < 2e-1)"
_DISTANCE = f"CASE WHEN {_RELIABLE} THEN 1000 / parallax ELSE 0 END"
_DATE_KEY = "CAST(year AS VARCHAR) || lpad(CAST(month AS VARCHAR), 2, '0') || lpad(CAST(day AS VARCHAR), 2, '0')"


def _magnitude(m: str, zero: str = "CAST('Infinity' AS DOUBLE)") -> str:
    return (
        f"CASE WHEN {m} IS NULL THEN NULL WHEN distance_pc = 0 THEN {zero}"
        f" ELSE CAST({m} AS DOUBLE) - 5 * log10(distance_pc) + 5 END"
    )


def _rank1(source: str, key: str, order: str) -> str:
    return f"(SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1)"


_MEASURED = ("ra", "dec", "parallax", "parallax_error", "pmra", "pmdec", "ruwe")


def _sources(columns: str, wide: bool = False) -> str:
    return f"""(SELECT {columns}, {_DATE_KEY} AS fct_dt FROM {stars(wide)} WHERE source_id IS NOT NULL
      UNION ALL SELECT {columns}, {_DATE_KEY} AS fct_dt FROM {stars(wide, 2)} WHERE source_id IS NOT NULL)"""


def astrometry(wide: bool = False) -> str:
    ties = ", ".join(f"{c} NULLS FIRST" for c in _MEASURED)
    latest = _rank1(_sources("source_id, " + ", ".join(_MEASURED), wide), "source_id", f"fct_dt DESC, {ties}")
    x, y, z = _unit("ra", "dec")
    return f"""(SELECT source_id, {", ".join(_MEASURED)}, fct_dt, healpix_index, {x} AS x_unit, {y} AS y_unit,
      {z} AS z_unit, ruwe < 1.4e0 AS is_reliable_astro, {_RELIABLE} AS is_reliable_plx FROM {healpix(latest)})"""


def photometry(wide: bool = False) -> str:
    ties = ", ".join(f"{c} NULLS FIRST" for c in ("j_m", "h_m", "ks_m", "ra", "dec"))
    latest = _rank1(_sources("source_id, j_m, h_m, ks_m, ra, dec", wide), "source_id", f"fct_dt DESC, {ties}")
    return f"""(SELECT source_id, j_m, h_m, ks_m, fct_dt, healpix_index, ra, dec, j_m - h_m AS color_j_h,
      h_m - ks_m AS color_h_ks FROM {healpix(latest)})"""


def object_rows(wide: bool = False) -> str:
    return f"""(SELECT trim(main_id) AS main_id, ra_deg AS ra, dec_deg AS dec, {_DATE_KEY} AS fct_dt, healpix_index
      FROM {healpix(objects(wide), "ra_deg", "dec_deg")})"""


def dimension(wide: bool = False) -> str:
    first = _rank1(object_rows(wide), "main_id", "fct_dt DESC, ra, dec")
    return f"""(SELECT main_id, ra, dec, healpix_index,
      md5(main_id || '|' || CAST(ra AS VARCHAR) || '|' || CAST(dec AS VARCHAR)) AS bk_simbad FROM {first})"""


def astro_photo(wide: bool = False) -> str:
    return f"""(SELECT a.source_id, p.j_m, p.h_m, p.ks_m, p.color_j_h, p.color_h_ks, a.parallax, a.parallax_error,
      a.is_reliable_plx, a.pmra, a.pmdec, a.ruwe, a.x_unit, a.y_unit, a.z_unit, coalesce(a.ra, p.ra) AS ra,
      coalesce(a.dec, p.dec) AS dec, coalesce(a.healpix_index, p.healpix_index) AS healpix_index
      FROM {astrometry(wide)} a JOIN {photometry(wide)} p ON a.source_id = p.source_id)"""


def _rounded(columns: str, digits: int = 9) -> str:
    """``a, b`` → rounded select items; positions always keep nine digits."""
    names = columns.replace(",", " ").split()
    places = {c: 9 if c in ("ra", "dec") else digits for c in names}
    return ", ".join(f"round(CAST({c} AS DOUBLE), {places[c]}) AS {c}" for c in names)


def gold_fact() -> str:
    flat = _flat("s.ra", "s.dec", *_moved("d.ra", "d.dec", "s.pmra", "s.pmdec"))
    pairs = f"""(SELECT s.*, d.bk_simbad, {flat} AS separation FROM {astro_photo()} s
      LEFT JOIN {dimension()} d ON s.healpix_index = d.healpix_index)"""
    best = _rank1(pairs, "source_id", "separation, bk_simbad")
    return f"""SELECT source_id, healpix_index,
      {_rounded("j_m, h_m, ks_m, parallax, parallax_error, pmra, pmdec, ruwe, ra, dec", 6)},
      CASE WHEN separation <= 1e0 / 36e2 THEN bk_simbad ELSE '-1' END AS bk_simbad,
      round(x_unit, 6) AS x, round(y_unit, 6) AS y, round(z_unit, 6) AS z,
      {_rounded("color_j_h, color_h_ks, distance_pc", 6)},
      round({_magnitude("j_m")}, 6) AS abs_mag_j, round({_magnitude("h_m")}, 6) AS abs_mag_h,
      round({_magnitude("ks_m")}, 6) AS abs_mag_ks,
      round(4.74e0 * distance_pc * sqrt(pow(pmra, 2)) + pow(pmdec, 2), 7) AS tangential_velocity
      FROM (SELECT *, CASE WHEN is_reliable_plx THEN 1000 / parallax ELSE 0 END AS distance_pc FROM {best})"""


def gold_fact_exact() -> str:
    """Great circles over the whole sphere; declinations half a degree apart cannot match."""
    moved = _moved("d.ra", "d.dec", "s.pmra", "s.pmdec")
    sep = _great_circle("s.ra", "s.dec", *moved)
    stars_, dims = astro_photo(True), dimension(True)
    band = f"(SELECT *, unnest([floor(dec) - 1, floor(dec), floor(dec) + 1]) AS band FROM {dims})"
    close = f"""(SELECT s.source_id, d.bk_simbad, {sep} AS separation FROM {stars_} s JOIN {band} d
      ON floor(s.dec) = d.band WHERE {sep} <= 1e0 / 36e2)"""
    best = _rank1(close, "source_id", "separation, bk_simbad")
    return f"""SELECT s.source_id, coalesce(b.bk_simbad, '-1') AS bk_simbad, s.healpix_index
      FROM {stars_} s LEFT JOIN {best} b ON s.source_id = b.source_id"""


def _chain(star_rows: str) -> str:
    return f"""(SELECT g.*, x.angular_distance AS angular_distance_arcsec, t.j_m, t.h_m, t.ks_m FROM {star_rows} g
      LEFT JOIN {NEIGHBOURS} x ON g.source_id = x.source_id LEFT JOIN {BRIDGE} b ON x.oid = b.oid
      LEFT JOIN {INFRARED} t ON b.designation = t.designation)"""


_BARE = f"(SELECT * EXCLUDE (j_m, h_m, ks_m, year, month, day) FROM {stars()})"
_CENTER = ("(2 + 7 / 6e1 + 104e-1 / 36e2) * 15", "(23 + 27 / 6e1 + 447e-1 / 36e2)")
_EXTRACT = (
    "ra, dec, parallax, parallax_error, pmra, pmdec, phot_g_mean_mag, phot_bp_mean_mag, phot_rp_mean_mag,"
    " j_m, h_m, ks_m, ruwe, angular_distance_arcsec"
)


def _in_center(source: str) -> str:
    return f"(SELECT * FROM {source} WHERE {_chord2(('ra', 'dec'), _CENTER)} <= {_chord_limit(5)})"


_INDIVIDUAL = _chain(_in_center(_BARE))


def _cone_counts(radius: float) -> str:
    near = f"{_chord2(('c.ra', 'c.dec'), ('s.ra', 's.dec'))} <= {_chord_limit(radius)}"
    # declinations further apart than the radius cannot meet
    return f"""(SELECT c.main_id, c.ra, c.dec, count(s.source_id) AS n_obs FROM {centers()} c LEFT JOIN {stars()} s
      ON s.dec BETWEEN c.dec - {radius}e0 - 1e-6 AND c.dec + {radius}e0 + 1e-6 AND {near} GROUP BY ALL)"""


def _density_extract() -> str:
    """Every star against every cone whose declinations can meet."""
    own = "2 * sin(radians(k.radius_deg) / 2)"
    return f"""SELECT k.main_id, s.source_id, round(k.radius_deg, 9) AS radius_deg FROM (
      SELECT main_id, ra, dec, CASE WHEN n_obs = 0 THEN 2e0 ELSE least(2e0, greatest(1e-1,
        sqrt(12 / (n_obs / (pi() * pow(1e-1, 2))) / pi()))) END AS radius_deg FROM {_cone_counts(0.1)}) k
      JOIN {stars()} s ON s.dec BETWEEN k.dec - k.radius_deg - 1e-6 AND k.dec + k.radius_deg + 1e-6
      AND {_chord2(("k.ra", "k.dec"), ("s.ra", "s.dec"))} <= pow({own}, 2)"""


def _in_reach(places: str, objects: str) -> str:
    """Per position: objects within a degree, and the name of the nearest."""
    separation = _great_circle("s.ra", "s.dec", "c.ra", "c.dec")
    return f"""(SELECT s.ra, s.dec, count(*) AS n_objects, first(c.main_id ORDER BY round({separation}, 9), c.main_id) AS source_cluster
      FROM (SELECT DISTINCT ra, dec FROM {places}) s JOIN {objects} c ON s.dec BETWEEN c.dec - 1.001 AND c.dec + 1.001
      AND {_chord2(("s.ra", "s.dec"), ("c.ra", "c.dec"))} <= {_chord_limit(1)} GROUP BY s.ra, s.dec)"""


def tiled(columns: str) -> str:
    return f"(SELECT {columns}, healpix_index, healpix_index >> 8 AS sky_tile FROM {healpix(stars())})"


_CONTROL = """(SELECT 'job-' || o_custkey AS id, 'pipeline_' || o_custkey AS pipeline,
  CASE WHEN o_custkey % 3 <> 0 THEN make_date(1990 + o_custkey % 5, 1, 15) END AS genesis,
  CASE WHEN o_custkey % 2 = 0 THEN CAST(o_orderdate AS DATE) END AS "current",
  CASE WHEN o_custkey % 2 = 0 THEN 'silver' ELSE 'gold' END AS layer, o_orderdate AS updated_at FROM orders)"""
_CONTROL_STATE = _rank1(_CONTROL, "id", 'updated_at DESC, "current" DESC')

_EVENT_BATCHES = """(SELECT event_type AS catalog, batch_no, count(*) AS n_records,
  sha256('[' || string_agg(record, ',' ORDER BY event_id) || ']') AS hash FROM (
    SELECT event_type, event_id,
      CAST(to_json({'event_id': event_id, 'user_id': user_id, 'props': props}) AS VARCHAR) AS record,
      (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 1000 AS batch_no FROM events)
  GROUP BY event_type, batch_no)"""
_LANDED_EVENTS = f"""SELECT e.event_type AS catalog, b.hash, e.event_id, e.user_id, e.props FROM (
    SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 1000 AS batch_no FROM events) e
  JOIN {_EVENT_BATCHES} b ON e.event_type = b.catalog AND e.batch_no = b.batch_no"""
# the same records under a second catalogue
_LANDED_TWICE = f"""SELECT catalog || suffix AS catalog, hash, event_id, user_id, props
  FROM ({_LANDED_EVENTS}), (VALUES (''), ('_mirror')) AS v(suffix)"""

_PLANET_COLUMNS = f"""pl_name, {{mass}}, hostname, {_rounded("ra, dec")}, gaia_dr3_id, sy_snum, sy_mnum, sy_pnum, soltype,
  {{method}}, {{year}}, disc_locale, disc_telescope, obm_flag, micro_flag, releasedate, elon, elat"""
_PLANETS_AS_IS = _PLANET_COLUMNS.format(mass="round(pl_masse, 9) AS pl_masse", method="discoverymethod", year="disc_year")
_PLANETS_ZEROED = _PLANET_COLUMNS.format(
    mass="round(coalesce(pl_masse, 0), 9) AS pl_masse",
    method="coalesce(discoverymethod, '') AS discoverymethod",
    year="coalesce(disc_year, 0) AS disc_year",
)
_NORTH = 16


def oracle_sql() -> dict[str, str]:
    x, y, z = _unit("ra", "dec")
    moved = _moved("ra", "dec", "pmra", "pmdec")
    with_distance = f"(SELECT *, {_DISTANCE} AS distance_pc FROM {stars()})"
    both = f"""(SELECT source_id, ra, dec, parallax, pmra, {_DATE_KEY} AS fct_dt FROM {stars()}
      UNION ALL SELECT source_id, ra, dec, parallax, pmra, {_DATE_KEY} AS fct_dt FROM {stars(observation=2)})"""
    all_cols = "source_id, healpix_index, fct_dt"
    pixel_stars = healpix(f"(SELECT source_id, ra, dec, pmra, pmdec FROM {stars()})")
    pixel_flat = _flat("s.ra", "s.dec", *_moved("d.ra", "d.dec", "s.pmra", "s.pmdec"))
    three = tiled("source_id, ra, dec")
    return {
        "healpix_index": f"""SELECT source_id, healpix_index, healpix_10, healpix_index >> 6 AS healpix_3
          FROM {healpix(healpix(f"(SELECT source_id, ra, dec FROM {stars(True)})"), depth=10, out="healpix_10")}""",
        "unit_vectors": f"""SELECT source_id, round({x}, 9) AS x_unit, round({y}, 9) AS y_unit, round({z}, 9) AS z_unit
          FROM {stars(True)}""",
        "angular_distance": f"""SELECT source_id, round({_flat("ra", "dec", *moved)}, 9) AS threshold_angular_d,
          round({_great_circle("ra", "dec", *moved)}, 9) AS exact_d,
          round({_great_circle("ra", "dec", "2e2", "-45e0")}, 7) AS far_d FROM {stars()}""",
        "distance_pc": f"SELECT source_id, round(distance_pc, 9) AS distance_pc FROM {with_distance}",
        "absolute_magnitude": f"""SELECT source_id, round({_magnitude("j_m")}, 6) AS abs_mag_j,
          round({_magnitude("h_m")}, 6) AS abs_mag_h, round({_magnitude("ks_m")}, 6) AS abs_mag_ks,
          round({_magnitude("j_m", "NULL")}, 6) AS known_mag_j FROM {with_distance}""",
        "propagate_motion": f"SELECT source_id, round({moved[0]}, 9) AS ra_prop, round({moved[1]}, 9) AS dec_prop FROM {stars()}",
        "tangential_velocity": f"""SELECT source_id,
          round(4.74e0 * distance_pc * sqrt(pow(pmra, 2)) + pow(pmdec, 2), 7) AS tangential_velocity,
          round(4.74e0 * (distance_pc / 1000) * sqrt(pow(pmra, 2) + pow(pmdec, 2)), 7) AS velocity_km_s
          FROM {with_distance}""",
        "quality_flags": f"""SELECT source_id, ruwe < 1.4e0 AS is_reliable_astro, {_RELIABLE} AS is_reliable_plx
          FROM {stars()}""",
        "sexagesimal_to_deg": """SELECT o_orderkey AS source_id,
          printf('%02dh%02dm%02d.%02ds', o_orderkey % 24, o_orderkey % 60, o_orderkey * 7 % 60, o_orderkey * 3 % 100) AS ra_text,
          printf('%s%02dd%02dm%02d.%ds', CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END, o_orderkey % 90,
            o_orderkey % 60, o_orderkey * 11 % 60, o_orderkey * 3 % 10) AS dec_text,
          round(15 * (o_orderkey % 24 + (o_orderkey % 60) / 6e1
            + (o_orderkey * 7 % 60 + (o_orderkey * 3 % 100) / 1e2) / 36e2), 9) AS ra,
          round(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END * (o_orderkey % 90 + (o_orderkey % 60) / 6e1
            + (o_orderkey * 11 % 60 + (o_orderkey * 3 % 10) / 1e1) / 36e2), 9) AS dec FROM orders""",
        "date_key": f"SELECT source_id, strftime(make_date(year, month, day), '%Y%m%d') AS fct_dt FROM {stars()}",
        "union_sources": f"SELECT source_id, {_rounded('ra, dec, parallax')}, fct_dt FROM {both}",
        "keep_latest": f"""SELECT source_id, fct_dt, {_rounded("parallax, pmra")} FROM (
          SELECT * FROM {both} WHERE source_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_id
            ORDER BY fct_dt DESC, parallax NULLS FIRST, pmra NULLS FIRST) = 1)""",
        "nearest_rank": f"""SELECT source_id, angular_distance AS threshold_angular_d,
          CASE WHEN angular_distance <= 5e-2 THEN 'P' || lpad(CAST(oid AS VARCHAR), 12, '0') ELSE '-1' END AS bk_simbad
          FROM {_rank1(NEIGHBOURS, "source_id", "angular_distance, oid")}""",
        "silver_astrometry": f"""SELECT {all_cols}, {_rounded(", ".join(_MEASURED) + ", x_unit, y_unit, z_unit")},
          is_reliable_astro, is_reliable_plx FROM {astrometry()}""",
        "silver_photometry": f"""SELECT {all_cols},
          {_rounded("j_m, h_m, ks_m, ra, dec, color_j_h, color_h_ks", 6)} FROM {photometry()}""",
        "silver_clusters": f"SELECT main_id, {_rounded('ra, dec')}, fct_dt, healpix_index FROM {object_rows()}",
        "dim_clusters": f"SELECT main_id, {_rounded('ra, dec')}, healpix_index, bk_simbad FROM {dimension()}",
        "gold_fact": gold_fact(),
        "gold_fact_bucketed": gold_fact(),
        "gold_fact_exact": gold_fact_exact(),
        "raw_cluster_extract": f"""SELECT source_id, {_rounded(_EXTRACT, 6)}, n_objects, source_cluster
          FROM {_INDIVIDUAL} JOIN {_in_reach(_INDIVIDUAL, _in_center(centers()))} USING (ra, dec)""",
        "raw_individual_extract": f"SELECT source_id, {_rounded(_EXTRACT, 6)} FROM {_INDIVIDUAL}",
        "join_astro_photo": f"""SELECT source_id, is_reliable_plx, healpix_index, {_rounded("j_m, h_m, ks_m, color_j_h,"
          " color_h_ks, parallax, parallax_error, pmra, pmdec, ruwe, x_unit, y_unit, z_unit, ra, dec", 6)} FROM {astro_photo()}""",
        "join_pixel_left": f"""SELECT s.source_id, s.healpix_index, d.bk_simbad, round({pixel_flat}, 9) AS threshold_angular_d
          FROM {pixel_stars} s LEFT JOIN {dimension()} d
          ON s.healpix_index = d.healpix_index AND {pixel_flat} <= 5e0 / 36e2""",
        "pixel_candidates": f"""SELECT s.source_id, s.healpix_index, count(d.bk_simbad) AS candidates,
          min(d.bk_simbad) AS first_bk, max(d.bk_simbad) AS last_bk FROM {pixel_stars} s
          LEFT JOIN {dimension()} d ON s.healpix_index = d.healpix_index GROUP BY s.source_id, s.healpix_index""",
        "left_join_chain": f"SELECT source_id, {_rounded('angular_distance_arcsec, j_m, h_m, ks_m', 6)} FROM {_chain(_BARE)}",
        "cone_search": f"""SELECT source_id, {_rounded("ra, dec")} FROM {stars(True)}
          WHERE {_great_circle("ra", "dec", "2e0", "80e0")} <= 15""",
        "cone_search_tiles": f"""SELECT source_id, {_rounded("ra, dec")} FROM {stars(True)}
          WHERE {_great_circle("ra", "dec", "2e0", "80e0")} <= 15""",
        "cone_count": f"SELECT main_id, {_rounded('ra, dec')}, n_obs FROM {_cone_counts(1)}",
        "density_radius": f"""SELECT main_id, {_rounded("ra, dec")}, n_obs, round(least(2e0, greatest(1e-1,
          sqrt(250000 / (n_obs / (pi() * pow(1e-1, 2))) / pi()))), 9) AS radius_deg FROM {_cone_counts(0.1)}""",
        "density_extract": _density_extract(),
        "valid_coords": f"""SELECT source_id, {_rounded("ra, dec")} FROM {stars()}
          WHERE source_id % 23 <> 0 AND source_id % 29 <> 0""",
        "sky_pairs_within": f"""SELECT source_id, {_rounded("ra, dec")}, coalesce(n_objects, 0) AS n_objects, source_cluster AS nearest
          FROM {stars(True)} LEFT JOIN {_in_reach(stars(True), centers(True))} USING (ra, dec)""",
        "conform_schema": """SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey,
          CASE WHEN price = floor(price) THEN CAST(price AS BIGINT) END AS o_totalprice,
          strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority, CAST(NULL AS VARCHAR) AS clerk,
          CASE WHEN price = floor(price) THEN '' ELSE 'o_totalprice' END AS cast_errors FROM (
            SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN floor(o_totalprice) ELSE o_totalprice END AS price FROM orders)""",
        "schema_check": f"""SELECT source_id, {_rounded("j_m, h_m, ks_m", 6)}, {_DATE_KEY} AS fct_dt, healpix_index
          FROM {healpix(stars())}""",
        "catalog_projection": f"SELECT {_PLANETS_AS_IS} FROM {PLANETS} ORDER BY gaia_dr3_id",
        "serve_ids": f"SELECT source_id FROM {astrometry()} ORDER BY source_id LIMIT 10",
        "csv_infer": """SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS o_custkey,
          CASE WHEN o_orderkey % 15 <> 1 THEN o_orderstatus END AS o_orderstatus,
          CASE WHEN o_orderkey % 20 <> 2 THEN round(o_totalprice, 2) END AS o_totalprice,
          CAST(o_orderdate AS DATE) AS o_orderdate, o_orderkey % 2 = 0 AS is_even,
          'say "' || o_orderpriority || '", now' || CASE WHEN o_orderkey % 7 = 0 THEN chr(10) || ' or never' ELSE '' END AS remark
          FROM orders""",
        "conform_files": """SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey,
          CASE o_orderkey % 3 WHEN 0 THEN o_totalprice WHEN 1 THEN CAST(CAST(floor(o_totalprice) AS FLOAT) AS DOUBLE) END AS o_totalprice,
          CASE WHEN o_orderkey % 3 <> 1 THEN o_orderstatus END AS o_orderstatus FROM orders""",
        "binary_inventory": """SELECT item_id, CAST(strlen(text) + 1 AS BIGINT) AS length, sha256(text || chr(10)) AS sha256
          FROM benchmark""",
        "scan_recursive": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
        "scan_merge_schema": """SELECT o_orderkey, o_custkey, CAST(NULL AS DOUBLE) AS o_totalprice, 1999 AS year FROM orders
          UNION ALL SELECT o_orderkey, NULL, o_totalprice, 2000 FROM orders""",
        "bronze_load": f"""SELECT source_id, {_rounded("ra, dec, parallax", 6)}, CAST(phot_bp_mean_mag AS VARCHAR) AS phot_bp_mean_mag,
          CAST(NULL AS VARCHAR) AS vbroad, {_rounded("j_m", 6)}, 2026 AS year, 6 AS month, 19 AS day FROM {stars()}""",
        "bronze_load_csv": """SELECT p_partkey AS clean_tmass_psc_xsc_oid,
          'T' || CAST(p_partkey // 16 AS BIGINT) AS original_psc_source_id, 2026 AS year, 6 AS month, 19 AS day FROM part""",
        "medallion": _medallion(),
        "json_records": f"SELECT {_PLANETS_ZEROED} FROM {PLANETS}",
        "json_event_props": """SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN CAST(props ->> '$.k' AS BIGINT) END AS k,
          CASE WHEN event_id % 50 <> 0 THEN '' END AS missing, CASE WHEN event_id % 50 = 0 THEN '[{broken' END AS corrupt
          FROM events""",
        "json_reject_catalogs": """SELECT event_id, user_id % 61 AS catalog, coalesce(CAST(props ->> '$.k' AS BIGINT), 0) AS k FROM events
          WHERE user_id % 61 NOT IN (SELECT user_id % 61 FROM events WHERE event_id % 997 = 0)""",
        "json_first_link": "SELECT page_id, CASE WHEN page_id % 10 <> 0 THEN url END AS url FROM pages",
        "load_metrics": """SELECT count(*) AS n_records, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes,
          count(*) FILTER (lang = 'en') AS n_english FROM documents""",
        "table_create_sync": f"SELECT source_id, {_rounded('ra, dec')}, healpix_index, sky_tile FROM {three}",
        "table_add_columns": f"""SELECT source_id, round(ra, 9) AS ra,
          CASE WHEN sky_tile < {_NORTH} THEN round(dec, 9) END AS dec,
          CASE WHEN sky_tile >= {_NORTH} THEN round(parallax, 9) END AS parallax, healpix_index, sky_tile
          FROM {tiled("source_id, ra, dec, parallax")}""",
        "table_retyped": """SELECT o_orderkey, CAST(o_orderkey % 30 AS INTEGER) AS mag, 1 AS part FROM orders
          UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 30 + 1 AS INTEGER) END,
            CASE WHEN o_orderkey % 3 <> 0 THEN 2 ELSE 0 END FROM orders""",
        "overwrite_partitions": f"""SELECT CASE WHEN sky_tile >= {_NORTH} THEN source_id + 1000000 ELSE source_id END AS source_id,
          {_rounded("ra, dec")}, healpix_index, sky_tile FROM {three}""",
        "purge_moved": f"""SELECT source_id, {_rounded("ra, dec")}, healpix_index,
          CASE WHEN sky_tile >= {_NORTH} THEN 999 ELSE sky_tile END AS sky_tile FROM {three}""",
        "clustered_write": f"SELECT source_id, {_rounded('ra, dec')}, healpix_index, sky_tile FROM {three}",
        "control_lookup": f"""SELECT layer, pipeline,
          coalesce(CAST("current" AS VARCHAR), CAST(genesis AS VARCHAR), '2026-06-19') AS target_date FROM {_CONTROL_STATE}
          UNION ALL SELECT 'bronze', 'seed_' || r_regionkey, '1990-01-15' FROM region
          UNION ALL SELECT 'asked', 'seed_1', '1990-01-15'""",
        "control_since": f"SELECT source_id, fct_dt FROM {both} WHERE fct_dt >= '19950115'",
        "control_advance": f"""SELECT pipeline, genesis,
          CASE WHEN layer = 'silver' THEN DATE '2026-06-19' ELSE "current" END AS "current", layer FROM {_CONTROL_STATE}
          UNION ALL SELECT 'seed_' || r_regionkey, DATE '1990-01-15', CASE WHEN r_regionkey = 0 THEN DATE '2026-06-19' END, 'bronze' FROM region
          UNION ALL SELECT 'new_job', NULL, DATE '2026-06-19', 'bronze'""",
        "batch_hash": f"SELECT catalog, batch_no, n_records, hash FROM {_EVENT_BATCHES}",
        "stream_landing": _LANDED_TWICE,
        "stream_dead_letter": f"""SELECT '{{"catalog": "' || catalog || '", cut off at ' || hash AS malformed
          FROM {_EVENT_BATCHES}""",
        "stream_watermark": _LANDED_TWICE,
        "catalog_landing": f"SELECT 'ps' AS catalog, {_PLANETS_ZEROED} FROM {PLANETS}",
    }


def _medallion() -> str:
    """The gold chain on a single observation of each star and object."""
    pix_s = healpix(stars())
    pix_d = f"""(SELECT *, md5(main_id || '|' || CAST(ra AS VARCHAR) || '|' || CAST(dec AS VARCHAR)) AS bk
      FROM {healpix(centers())})"""
    flat = _flat("s.ra", "s.dec", *_moved("d.ra", "d.dec", "s.pmra", "s.pmdec"))
    close = f"""(SELECT s.source_id, d.bk, {flat} AS separation FROM {pix_s} s JOIN {pix_d} d
      ON s.healpix_index = d.healpix_index WHERE {flat} <= 1e0 / 36e2)"""
    return f"""SELECT s.source_id, s.healpix_index, coalesce(b.bk, '-1') AS bk_simbad,
      round({_DISTANCE}, 6) AS distance_pc, round(CAST(s.j_m AS DOUBLE), 6) AS j_m
      FROM {pix_s} s LEFT JOIN {_rank1(close, "source_id", "separation, bk")} b ON s.source_id = b.source_id"""
