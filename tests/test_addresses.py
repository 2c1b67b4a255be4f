"""Addresses of both families against the standard library and all blocks."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators import addresses

TEXTS = ["1.2.3.4", "0.0.0.0", "255.255.255.255", "256.1.1.1", "1.2.3", "1.2.3.4.5", "::", "::1", "1::", "2001:db8::8:800:200c:417a",
         "2001:DB8:0:0:8:800:200C:417A", "::ffff:1.2.3.4", "64:ff9b::1.2.3.4", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9",
         "1::2::3", ":1:2:3:4:5:6:7:8", "12345::", "g::", "", " ", "1:2:3:4:5:6:7::", "::1.2.3", "x", "::ffff:1.2.3.400", "1.2.3.4::"]


def key(text):
    try:
        found = ipaddress.ip_address(text)
    except ValueError:
        return None
    return f"{int(found) if found.version == 6 else int(found) + (0xFFFF << 32):032x}"


def test_keys(spark):
    rows = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string")
    found = {r.t: r.k for r in rows.select("t", addresses.address_key(F.col("t")).alias("k")).collect()}
    assert found == {t: key(t) for t in TEXTS} | {None: None}


def test_prefixes_make_up_the_range():
    rng = random.Random(1)
    for _ in range(300):
        low, high = sorted(rng.randrange(1 << rng.choice([4, 8, 33, 128])) for _ in range(2))
        parts = addresses.prefixes(low, high)
        assert parts[0][0] == low and sum(1 << 128 - n for _, n in parts) == high - low + 1 and len(parts) <= 254
        assert all(a % (1 << 128 - n) == 0 for a, n in parts)
        assert [a for a, _ in parts[1:]] == [a + (1 << 128 - n) for a, n in parts[:-1]]
    assert addresses.prefixes(0, (1 << 128) - 1) == [(0, 0)]


def test_blocks_and_unreadable_bounds(spark):
    raw = [("10.0.0.0", "10.0.0.255", "a"), ("167772160", "167772161", "b"), ("2001:db8::/33", None, "c"), ("192.168.7.9/30", "", "d"), ("::/0", None, "e"),
           ("10.0.0.9", "10.0.0.1", "bad"), ("10.0.0.x", "10.0.0.9", "bad"), ("2001::/129", None, "bad"), (None, None, "bad"), ("1.2.3.4", None, "bad")]
    good, bad = addresses.address_blocks(spark.createDataFrame(raw, "start_ip string, end_ip string, name string"))
    assert bad.count() == 5 and {r.name for r in bad.collect()} == {"bad"}
    found = {r.name: (r.lo, r.hi) for r in good.collect()}
    for name, net in (("c", "2001:db8::/33"), ("e", "::/0")):
        own = ipaddress.ip_network(net)
        assert found[name] == (key(str(own[0])), key(str(own[-1])))
    assert found["a"] == (key("10.0.0.0"), key("10.0.0.255")) and found["b"] == (key("10.0.0.0"), key("10.0.0.1"))
    assert found["d"] == (key("192.168.7.8"), key("192.168.7.11"))


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_lookup_equals_all_blocks(spark, limit):
    """Nested blocks of all sizes, both families; by broadcast and shuffled, each row once."""
    rng = random.Random(4)
    blocks, points = [], [key("9.9.9.9"), key("fe80::1")]
    for base, bits in ((int(key("10.0.0.0"), 16), 24), (int(key("2001:db8::"), 16), 96)):
        low, high = base, base + (1 << bits) - 1
        for _ in range(60):
            if rng.random() < 0.3:
                low, high = base, base + (1 << bits) - 1
            a, b = sorted(rng.randint(low, high) for _ in range(2))
            blocks.append((f"{a:032x}", f"{b:032x}", f"n{len(blocks)}"))
            low, high = a, b  # the next one lies inside
            points += [f"{x:032x}" for x in (a, b, rng.randint(a, b), max(a - 1, 0))]
    # Only nested or apart: blocks that cut each other are left out.
    spans = [(int(a, 16), int(b, 16), n) for a, b, n in blocks]
    clean = [s for k, s in enumerate(spans) if not any(
        (o[0] < s[0] <= o[1] < s[1]) or (s[0] < o[0] <= s[1] < o[1]) for o in spans[:k])]
    frame = spark.createDataFrame([(f"{a:032x}", f"{b:032x}", n) for a, b, n in clean], "lo string, hi string, name string")
    table = addresses.prepare_addresses(frame, ["name"], broadcast_limit=limit)
    assert table.keys.small == bool(limit) and list(table.levels) == sorted(table.levels, reverse=True)
    texts = [str(ipaddress.IPv6Address(int(p, 16))) for p in points] + [None, "junk"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, ip string")
    out = addresses.address_lookup(rows, table, {"found": F.col("ip")}, F.col("i")).collect()
    assert sorted(r.i for r in out) == list(range(len(texts))) and set(out[0].asDict()) == {"i", "ip", "found"}
    for r in out:
        at = int(points[r.i], 16) if r.i < len(points) else -1
        holding = sorted((b - a, n) for a, b, n in clean if a <= at <= b)
        assert (r.found and r.found.name) in ({n for w, n in holding if w == holding[0][0]} if holding else {None})
