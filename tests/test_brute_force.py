"""clean_sales against a plain-Python model of the same rules on random raw
lines (several seeds): hot sales, zero and unparsable surfaces, NULL keys,
mixed building / land sales."""

import random
from collections import defaultdict

import pytest

from parcelle.plans.clean import clean_sales
from parcelle.schema import RAW_SALES_COLUMNS, RAW_SALES_SCHEMA

NUMBERS = ["0", "1", "2.5", "10", "40", "75.5", "120", "500", "2000", "null", "12,5", None]
PRICES = ["1000", "5000", "20000", "150000", "400000", "2000000", "null", None]
TYPES = [None, None, "Maison", " appartement ", "MAISON", "Local"]
NATURES = [None, " sol ", "Bois", "pre", "SOL"]
DATES = ["2023-01-15", "2022-12-31", "15/01/2023", None]


def gen(seed, n=600):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        sale = "HOT" if rnd.random() < 0.3 else f"S{rnd.randrange(60)}"
        rows.append({
            "id_mutation": sale,
            "date_mutation": rnd.choice(DATES[:2]) if sale == "HOT" else rnd.choice(DATES),
            "valeur_fonciere": "150000" if sale == "HOT" else rnd.choice(PRICES),
            "type_local": rnd.choice(TYPES),
            "surface_reelle_bati": rnd.choice(NUMBERS),
            "surface_terrain": rnd.choice(NUMBERS),
            "nature_culture": rnd.choice(NATURES),
            "nombre_pieces_principales": rnd.choice(["1", "3", "x", None]),
            "code_postal": rnd.choice(["01000", "29000", None]),
            "nom_commune": "Brest",
            "code_departement": rnd.choice(["29", "2A"]),
            "longitude": rnd.choice(["-4.5", "-4.25", None]),
            "latitude": rnd.choice(["48.0", "48.125"]),
        })
    return rows


def num(s):
    if s is None:
        return None
    try:
        return float(s)
    except ValueError:
        return None


def integer(s):
    try:
        return int(s)
    except (TypeError, ValueError):
        return None


def date(s):
    if s is None or len(s) != 10 or s[4] != "-":
        return None
    return s


def norm(s):
    return None if s is None else s.strip(" ").lower()


def ratio(a, b):
    return None if a is None or b is None or b == 0 else a / b


def avg(xs):
    xs = [x for x in xs if x is not None]
    return sum(xs) / len(xs) if xs else None


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        price, bati, terrain = num(r["valeur_fonciere"]), num(r["surface_reelle_bati"]), num(r["surface_terrain"])
        base = (r["id_mutation"], date(r["date_mutation"]), price, r["code_postal"],
                r["nom_commune"], r["code_departement"])
        if r["type_local"] is not None:
            p = ratio(price, bati)
            if price is not None and bati is not None and p is not None and 100 <= p <= 20000:
                key = base + (norm(r["type_local"]), integer(r["nombre_pieces_principales"]))
                groups[key].append(r)
        else:
            p = ratio(price, terrain)
            if price is not None and terrain is not None and p is not None and 0.5 <= p <= 1000:
                groups[base + ("terrain", None)].append(r)
    out = {}
    for key, lines in groups.items():
        land = key[6] == "terrain"
        lon = avg([num(x["longitude"]) for x in lines])
        lat = avg([num(x["latitude"]) for x in lines])
        if land:
            total = sum(num(x["surface_terrain"]) for x in lines)
            natures = sorted(norm(x["nature_culture"]) for x in lines if x["nature_culture"] is not None)
            out[key] = dict(prix_m2=ratio(key[2], total), surface_terrain=total,
                            surface_totale_terrain=total, natures_culture=natures,
                            surface_reelle_bati=None, surface_totale_bati=None,
                            longitude=lon, latitude=lat)
        else:
            total = sum(num(x["surface_reelle_bati"]) for x in lines)
            terr = [num(x["surface_terrain"]) for x in lines if num(x["surface_terrain"]) is not None]
            out[key] = dict(prix_m2=ratio(key[2], total), surface_reelle_bati=total,
                            surface_totale_bati=total, surface_terrain=max(terr) if terr else None,
                            surface_totale_terrain=None, natures_culture=None,
                            longitude=lon, latitude=lat)
    return out


def close(a, b):
    if a is None or b is None:
        return a is b
    if isinstance(a, list):
        return a == b
    return a == pytest.approx(b, rel=1e-12)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_clean_sales_matches_brute_force(spark, seed):
    rows = gen(seed)
    raw = spark.createDataFrame([tuple(r[c] for c in RAW_SALES_COLUMNS) for r in rows],
                                RAW_SALES_SCHEMA).repartition(4)
    got = {}
    for r in clean_sales(raw).collect():
        d = r.asDict()
        key = (d["id_mutation"], d["date_mutation"] and d["date_mutation"].isoformat(),
               d["valeur_fonciere"], d["code_postal"], d["nom_commune"], d["code_departement"],
               d["type_local"], d["nombre_pieces_principales"])
        assert key not in got
        got[key] = d
    want = brute(rows)
    assert any(k[6] == "terrain" for k in want) and any(k[6] != "terrain" for k in want)
    assert any(k[0] == "HOT" for k in want)
    assert set(got) == set(want)
    for key, w in want.items():
        for col, value in w.items():
            assert close(got[key][col], value), (key, col, got[key][col], value)
