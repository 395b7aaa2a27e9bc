import random
from collections import Counter

import pytest

from zonereach.functions import geo
from zonereach.operators import dissolve, noding, rings
from zonereach.session import Scratch

W, H, SHEAR = 30, 20, 7
CELL = W * H / 1e12


def corner(c, r):
    return ((c * W + r * SHEAR) / 1e6, (r * H) / 1e6)


def block(c, r, w, h):
    """A block of cells as one ring, without vertices between its corners."""
    spots = [(c, r), (c + w, r), (c + w, r + h), (c, r + h), (c, r)]
    return [[dict(zip("xy", corner(*s))) for s in spots]]


def tiled(cells, rng):
    """Cells put together into blocks of up to 3 x 2, so that corners meet edges of others."""
    left, out = set(cells), []
    for c, r in sorted(cells):
        w, h = rng.choice([(1, 1), (2, 1), (1, 2), (2, 2), (3, 1), (3, 2)])
        own = {(c + i, r + j) for i in range(w) for j in range(h)}
        if not own <= left:
            own, w, h = {(c, r)}, 1, 1
        if (c, r) in left:
            left -= own
            out.append((c, r, w, h))
    return out


def components(cells):
    cells, out = set(cells), []
    while cells:
        todo, own = [cells.pop()], set()
        while todo:
            c, r = todo.pop()
            own.add((c, r))
            for n in ((c + 1, r), (c - 1, r), (c, r + 1), (c, r - 1)):
                if n in cells:
                    cells.remove(n)
                    todo.append(n)
        out.append(own)
    return out


def holes(part):
    """The regions around a part that have no way out, by edges."""
    lo, hi = min(min(x) for x in part) - 1, max(max(x) for x in part) + 1
    around = {(c, r) for c in range(lo, hi + 1) for r in range(lo, hi + 1)} - part
    return [h for h in components(around) if (lo, lo) not in h]


def table(spark, groups, rng):
    rows = [(name, f"{name}{i}", block(*b)) for name, cells in groups.items() for i, b in enumerate(tiled(cells, rng))]
    return spark.createDataFrame(rows, f"g string, geoid string, geometry array<{geo.RING}>").repartition(3)


FIXED = {
    # A ring of cells with an island in its hole, and a hole in the island.
    "nest": {(c, r) for c in range(9) for r in range(9) if c in (0, 8) or r in (0, 8)} | {(c, r) for c in range(2, 7) for r in range(2, 7) if (c, r) != (4, 4)},
    # Cells that touch in corners only.
    "corners": {(0, 0), (1, 1), (2, 2), (2, 0), (0, 2)},
    # A hole that touches the shell in a corner, and two holes that touch each other.
    "touch": {(c, r) for c in range(6) for r in range(5)} - {(0, 1), (1, 2), (3, 2), (4, 3), (4, 1)},
    "one": {(4, 4)},
}


def areas(parts):
    return Counter(round(a / CELL) for a in parts)


def check(spark, groups, rng):
    zones = table(spark, groups, rng)
    found = rings.dissolve_rings(zones, ["g"]).collect()
    for r in found:
        spots = [(p.x, p.y) for p in r.points]
        assert spots[0] == spots[-1] and len(set(spots)) == len(spots) - 1 == r.n
        assert (r.area > 0) == r.shell
        twice = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(spots, spots[1:]))
        assert twice / 2 == pytest.approx(r.area, abs=1e-15)
    by_ring = {(r.g, r.ring): r for r in found}
    for r in found:
        if r.parent is not None:
            p = by_ring[r.g, r.parent]
            assert p.shell != r.shell and p.depth == r.depth - 1 and abs(p.area) > abs(r.area)
        assert (r.parent is None) == (r.depth == 0) and r.shell == (r.depth % 2 == 0)
    whole = {r.g: r.area for r in dissolve.dissolve_attributes(zones, ["g"], []).collect()}
    polygons = rings.dissolve_polygons(zones, ["g"])
    own = polygons.select("g", "n_holes", "area", geo.area("geometry").alias("same"), geo.to_wkt("geometry").alias("wkt")).collect()
    for name, cells in groups.items():
        parts = components(cells)
        assert areas(r.area for r in found if r.g == name and r.shell) == Counter(len(p) + sum(map(len, holes(p))) for p in parts)
        assert areas(-r.area for r in found if r.g == name and not r.shell) == Counter(len(h) for p in parts for h in holes(p))
        assert Counter((round(r.area / CELL), r.n_holes) for r in own if r.g == name) == Counter((len(p), len(holes(p))) for p in parts)
        assert sum(r.area for r in own if r.g == name) == pytest.approx(whole[name])
    for r in own:
        assert r.area == pytest.approx(r.same) and r.wkt.startswith(("POLYGON", "MULTIPOLYGON"))


def test_islands_corners_and_touching_holes(spark):
    check(spark, FIXED, random.Random(1))


@pytest.mark.parametrize("seed", [2, 3])
def test_random_coverages(spark, seed):
    rng = random.Random(seed)
    groups = {f"g{i}": {(c, r) for c in range(9) for r in range(9) if rng.random() < share} for i, share in enumerate((0.25, 0.5, 0.6, 0.75, 0.9))}
    check(spark, groups, rng)


def test_outlines_do_not_depend_on_vertices(spark):
    rng = random.Random(4)
    cells = {(c, r) for c in range(12) for r in range(12) if rng.random() < 0.7}
    coarse = table(spark, {"a": cells}, rng)
    fine = spark.createDataFrame([("a", f"f{c},{r}", block(c, r, 1, 1)) for c, r in cells], coarse.schema)
    clean = {(r.x1, r.y1, r.x2, r.y2) for r in dissolve.outline(fine, ["g"]).collect()}
    by_line = {tuple(r) for r in noding.boundary(fine, ["g"]).select("x1", "y1", "x2", "y2").collect()}
    assert {min((a, b, c, d), (c, d, a, b)) for a, b, c, d in by_line} == clean
    # The coarse coverage bounds the same points, with fewer vertices on straight lines.
    on = {tuple(r) for r in noding.on_lines(noding.boundary(coarse, ["g"])).select("ux", "uy", "c").distinct().collect()}
    assert on == {tuple(r) for r in noding.on_lines(noding.boundary(fine, ["g"])).select("ux", "uy", "c").distinct().collect()}
    total = lambda df: noding.on_lines(noding.boundary(df, ["g"])).selectExpr("sum((hi - lo) * sign)", "sum(hi - lo)").first()
    assert total(coarse) == total(fine)


def test_links_across_corners_on_edges(spark):
    rng = random.Random(5)
    cells = {(c, r) for c in range(10) for r in range(10) if rng.random() < 0.75}
    blocks = tiled(cells, rng)
    owner = {(c + i, r + j): f"z{n:03d}" for n, (c, r, w, h) in enumerate(blocks) for i in range(w) for j in range(h)}
    zones = spark.createDataFrame([(f"z{n:03d}", "BG", block(*b)) for n, b in enumerate(blocks)], f"geoid string, level string, geometry array<{geo.RING}>")
    want = set()
    for (c, r), a in owner.items():
        for n in ((c + 1, r), (c, r + 1)):
            if n in owner and owner[n] != a:
                want.add((min(a, owner[n]), max(a, owner[n])))
    got = {(r.a, r.b) for r in dissolve.zone_links(zones).collect()}
    assert got == want
    # The pieces of all edges bear the same links.
    seg = noding.noded_segments(noding.on_lines(noding.directed_edges(zones)).drop("sign"), ["level"]).collect()
    sides = {}
    for r in seg:
        sides.setdefault((r.x1, r.y1, r.x2, r.y2), set()).add(r.geoid)
    assert {tuple(sorted(s)) for s in sides.values() if len(s) == 2} == want
    # With some zones there twice, copies are linked too, and nothing else changes.
    twice = zones.unionByName(zones.where("geoid < 'z010'").selectExpr("concat(geoid, 'x') as geoid", "level", "geometry"))
    links = {frozenset(x.rstrip("x") for x in (r.a, r.b)) for r in dissolve.zone_links(twice).collect()}
    assert {tuple(sorted(s)) for s in links if len(s) == 2} >= {w for w in want if w[0] >= "z010"}
    assert components_of(tuple(sorted(s)) for s in links if len(s) == 2) == components_of(want)


def components_of(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_overlapping_zones_are_an_error(spark):
    zones = spark.createDataFrame([("a", "x", block(0, 0, 2, 2)), ("a", "y", block(0, 0, 2, 1))], f"g string, geoid string, geometry array<{geo.RING}>")
    with pytest.raises(ValueError, match="overlap"):
        rings.dissolve_rings(zones, ["g"])


@pytest.mark.parametrize("sizes", [[1], [2, 3, 1], [64, 63, 65, 7], [500]])
def test_list_ranking(spark, sizes):
    rng = random.Random(sum(sizes))
    ids = rng.sample(range(10_000), sum(sizes))
    want, links, at = {}, [], 0
    for n in sizes:
        cycle = ids[at : at + n]
        at += n
        low = cycle.index(min(cycle))
        for k, node in enumerate(cycle):
            links.append((node, cycle[(k + 1) % n]))
            want[node] = (min(cycle), (low - k) % n)
    df = spark.createDataFrame(links, "id long, next long").repartition(3)
    got = {r.id: (r.ring, r.steps) for r in rings.cycle_order(Scratch(spark, "test"), df).collect()}
    assert got == want
