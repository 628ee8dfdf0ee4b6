"""The compatible 32-bit review key against a plain version of its hash."""

from reviewlake.operators.bronze import review_id

MASK = 0xFFFFFFFF


def rotated(x, n):
    return ((x << n) | (x >> (32 - n))) & MASK


def mixed(h, k):
    k = rotated(k * 0xCC9E2D51 & MASK, 15) * 0x1B873593 & MASK
    return (rotated(h ^ k, 13) * 5 + 0xE6546B64) & MASK


def murmur3(data, seed=42):
    """32-bit Murmur3 in which every byte beyond the last whole word is a block of its own, as a signed number."""
    whole = len(data) & ~3
    h = seed
    for i in range(0, whole, 4):
        h = mixed(h, int.from_bytes(data[i:i + 4], "little"))
    for b in data[whole:]:
        h = mixed(h, (b - 256 if b > 127 else b) & MASK)
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & MASK
    h = (h ^ h >> 13) * 0xC2B2AE35 & MASK
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def test_hash_key(spark):
    rows = [("P1", "Ana", "Ótimo atendimento 😀", 1640995200), ("P2", "", "", 0), ("P3", "Zé", "abc", -5),
            ("P4", None, "x", 1), ("P5", "Lia", "x" * 5000, 7)]
    df = spark.createDataFrame(rows, "place_id string, author_name string, review_text string, review_time long")
    got = {r["place_id"]: r["bronze_review_id"] for r in review_id(df).collect()}
    want = {p: f"{p}_{murmur3((a + t + str(n)).encode()) if a is not None else 42}" for p, a, t, n in rows}
    assert got == want
