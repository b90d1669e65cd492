"""A made-up set of fields around one scene and far from it, from a seeded generator."""

import random

_rng = random.Random(20)


def _near(at, spread, count):
    return [(at[0] + _rng.uniform(-spread, spread), at[1] + _rng.uniform(-spread, spread)) for _ in range(count)]


#: Middle of the scene; it reaches half a degree to all sides.
BASE = (round(_rng.uniform(4, 9), 2), round(_rng.uniform(46, 52), 2))
#: Fields in the north half of the scene, one in its south half, and groups and lone fields out of its reach.
NORTH = _near((BASE[0], BASE[1] + 0.2), 0.02, 4)
SOUTH = _near((BASE[0] + 0.1, BASE[1] - 0.3), 0.01, 1)
FAR = [p for k in range(4) for p in _near((BASE[0] + 2 + k, BASE[1] + _rng.uniform(-1, 1)), 0.03, _rng.randint(2, 4))]
FAR += _near((BASE[0] - 3, BASE[1] - 1), 0.5, 1)


def _days(places, first):
    return [(*p, f"2026-01-{first if i == 0 else _rng.randint(1, 3):02}") for i, p in enumerate(places)]


_placed = [("north", p) for p in _days(NORTH, 1)] + [("south", p) for p in _days(SOUTH, 1)] + [("far", p) for p in _days(FAR, 1)]
_rng.shuffle(_placed)
#: (field_id, lon, lat, planting date), the ids tell where a field lies.
FIELDS = [(f"{where}-{_rng.randrange(16**4):04x}", *p) for where, p in _placed]
