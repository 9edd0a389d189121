"""Checksum forms of addresses in check SQL: Keccak-256 as a recursive query."""

# Round constants and rotation offsets (index x + 5y) of Keccak-f[1600].
ROUNDS = (
    0x0000000000000001, 0x0000000000008082, 0x800000000000808A, 0x8000000080008000,
    0x000000000000808B, 0x0000000080000001, 0x8000000080008081, 0x8000000000008009,
    0x000000000000008A, 0x0000000000000088, 0x0000000080008009, 0x000000008000000A,
    0x000000008000808B, 0x800000000000008B, 0x8000000000008089, 0x8000000000008003,
    0x8000000000008002, 0x8000000000000080, 0x000000000000800A, 0x800000008000000A,
    0x8000000080008081, 0x8000000000008080, 0x0000000080000001, 0x8000000080008008,
)
OFFSETS = (0, 1, 62, 28, 27, 36, 44, 6, 55, 20, 3, 10, 43, 25, 39, 41, 45, 15, 21, 8, 18, 2, 61, 56, 14)


def _number(value):
    return f"{value}::UBIGINT"


def _xor(*terms):
    out = terms[0]
    for term in terms[1:]:
        out = f"xor({out}, {term})"
    return out


def _turned(x, bits):
    """`x` rotated left; masked first, since a shift must not overflow."""
    if bits == 0:
        return x
    kept = _number((1 << (64 - bits)) - 1)
    return f"((({x}) & {kept}) << {_number(bits)}) | (({x}) >> {_number(64 - bits)})"


def _list(items):
    return "[" + ", ".join(items) + "]"


def _round():
    """One round as nested selects over `k`; lists count from 1."""
    parity = _list(_xor(*(f"a[{x + 5 * y + 1}]" for y in range(5))) for x in range(5))
    mixed = _list(_xor(f"c[{(x + 4) % 5 + 1}]", _turned(f"c[{(x + 1) % 5 + 1}]", 1)) for x in range(5))
    added = _list(_xor(f"a[{i + 1}]", f"d[{i % 5 + 1}]") for i in range(25))
    moved = [""] * 25
    for x in range(5):
        for y in range(5):
            moved[y + 5 * ((2 * x + 3 * y) % 5)] = _turned(f"a[{x + 5 * y + 1}]", OFFSETS[x + 5 * y])
    ones = _number((1 << 64) - 1)
    mingled = [
        _xor(
            f"b[{x + 5 * y + 1}]",
            f"(xor(b[{(x + 1) % 5 + 5 * y + 1}], {ones}) & b[{(x + 2) % 5 + 5 * y + 1}])",
        )
        for y in range(5)
        for x in range(5)
    ]
    mingled[0] = _xor(mingled[0], f"{_list(map(_number, ROUNDS))}[r + 1]")
    return (
        f"SELECT key, r + 1 AS r, {_list(mingled)} AS a FROM (SELECT key, r, {_list(moved)} AS b "
        f"FROM (SELECT key, r, {added} AS a FROM (SELECT key, r, a, {mixed} AS d "
        f"FROM (SELECT key, r, a, {parity} AS c FROM k WHERE r < 24))))"
    )


def _first():
    """Lanes of the 40 lower-case digits with the padding of one block."""
    lanes = []
    for lane in range(25):
        if lane < 5:
            parts = (
                f"(ascii(substr(key, {3 + 8 * lane + i}, 1))::UBIGINT << {_number(8 * i)})" for i in range(8)
            )
            lanes.append("(" + " | ".join(parts) + ")")
        else:
            lanes.append(_number({5: 1, 16: 1 << 63}.get(lane, 0)))
    return _list(lanes)


def checksum_sql(keys: str, select: str, *parts: str) -> str:
    """`select` over a table `checksums` (key, checksum) of the distinct keys of a query.

    `parts` are further named queries (name AS (...)) that come first.
    """
    nibble = (
        "((a[i // 16 + 1] >> ((8 * ((i // 2) % 8)) + (CASE i % 2 WHEN 0 THEN 4 ELSE 0 END))::UBIGINT)"
        " & 15::UBIGINT)"
    )
    shown = (
        f"list_transform(range(0, 40), lambda i: CASE WHEN {nibble} >= 8 THEN upper(substr(key, (i + 3)::BIGINT, 1)) "
        "ELSE substr(key, (i + 3)::BIGINT, 1) END)"
    )
    named = [
        *parts,
        f"k AS (SELECT key, 0 AS r, {_first()} AS a FROM (SELECT DISTINCT key FROM ({keys})) "
        f"UNION ALL {_round()})",
        f"checksums AS (SELECT key, '0x' || array_to_string({shown}, '') AS checksum FROM k WHERE r = 24)",
    ]
    return "WITH RECURSIVE " + ",\n".join(named) + "\n" + select
