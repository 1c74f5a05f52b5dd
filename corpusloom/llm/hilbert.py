"""Shards along a Hilbert curve through several metadata dimensions.

Every dimension is quantised to a few bits, the cell of a row is numbered along
the Hilbert curve, and the rows in order of that number are cut into runs of equal
counts. A run covers a compact box of the dimensions, so the minimum and maximum
that a file keeps of each column prune on all of them. Everything is column
expressions; the curve is a small table of states built by a rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.ordering import in_order, ranked
from corpusloom.session import stage

BITS = 8
KEY_BYTES = 5


def curve_table(dims: int) -> tuple[list[int], list[int]]:
    """Place on the curve and next state for every state and cell.

    A state is the entry corner and the main direction of a sub-cube; the sub-cubes
    follow each other in Gray-code order, turned into the state's frame.
    """
    size, mask = 1 << dims, (1 << dims) - 1

    def turn(x: int, by: int) -> int:
        by %= dims
        return ((x >> by) | (x << (dims - by))) & mask

    gray = [i ^ (i >> 1) for i in range(size)]
    place = {g: i for i, g in enumerate(gray)}

    def ones(i: int) -> int:
        """Trailing one bits."""
        return (~i & (i + 1)).bit_length() - 1

    places, states = [], []
    for entry in range(size):
        for direction in range(dims):
            for cell in range(size):
                at = place[turn(cell ^ entry, direction + 1)]
                corner = 0 if at == 0 else gray[2 * ((at - 1) // 2)]
                step = 0 if at == 0 else ones(at - 1 if at % 2 == 0 else at) % dims
                places.append(at)
                states.append(
                    (entry ^ turn(corner, -(direction + 1))) * dims
                    + (direction + step + 1) % dims
                )
    return places, states


def curve_index(codes: list[Column], bits: int = BITS) -> Column:
    """Number along the Hilbert curve of a cell given by one code per dimension."""
    dims = len(codes)
    places, states = curve_table(dims)
    place_of, state_of = F.lit(places), F.lit(states)
    cells = F.array(
        *[
            sum(
                (F.shiftright(code, level).bitwiseAND(1) * (1 << d) for d, code in enumerate(codes)),
                F.lit(0),
            ).cast("int")
            for level in reversed(range(bits))
        ]
    )

    def step(seen: Column, cell: Column) -> Column:
        entry = seen["state"] * (1 << dims) + cell + 1
        return F.struct(
            F.element_at(state_of, entry).cast("int").alias("state"),
            (seen["at"] * (1 << dims) + F.element_at(place_of, entry)).cast("long").alias("at"),
        )

    begin = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("at"))
    return F.aggregate(cells, begin, step)["at"]


def size_code(size: str, bits: int = BITS) -> str:
    """A code that grows with the logarithm of a size: its bit length and three bits more.

    Sizes below 16 share the lowest codes.
    """
    width = f"greatest(5, length(bin({size})))"
    code = f"least(255, ({width} - 5) * 8 + cast(shiftright({size}, {width} - 4) & 7 AS int))"
    return f"shiftright({code}, {8 - bits})"


def text_code(column: str, lowest: str | None, highest: str | None, bits: int = BITS) -> str:
    """A code in the order of the strings, linear between the lowest and the highest.

    Strings count by the bytes that follow what the lowest and highest share; null
    has code 0.
    """
    low, high = (lowest or "").encode(), (highest or "").encode()
    shared = 0
    while shared < min(len(low), len(high)) and low[shared] == high[shared]:
        shared += 1

    def number(value: bytes) -> int:
        return int.from_bytes(value[shared : shared + KEY_BYTES].ljust(KEY_BYTES, b"\0"), "big")

    first, last = number(low), number(high)
    tail = f"hex(substring(encode({column}, 'UTF-8'), {shared + 1}, {KEY_BYTES}))"
    key = f"cast(conv(rpad({tail}, {2 * KEY_BYTES}, '0'), 16, 10) AS bigint)"
    return f"coalesce(cast(({key} - {first}L) * {1 << bits}L div {last - first + 1}L AS int), 0)"


def hilbert_shards(
    docs: DataFrame, shards: int = 40, bits: int = BITS, texts: tuple[str, ...] = ("source", "lang")
) -> DataFrame:
    """Shard and place in it of every document ``(doc_id, text, *texts)``.

    The dimensions are the ``texts`` columns and the size, UTF-8 bytes of the text
    plus 16. Rows of one cell follow each other by the checksum of their text and by
    doc_id, so copies lie side by side. Counts of the shards differ by one at most;
    with fewer rows than shards some stay empty. A null text has no bytes, a null in
    a dimension is its lowest code, a null doc_id sorts first, repeated rows take
    places of their own, other columns are not read, and an empty table gives no rows.
    """
    size = "coalesce(octet_length(text), 0) + 16"
    narrow = stage(
        docs.selectExpr(
            "doc_id",
            *(f"`{c}`" for c in texts),
            f"cast({size} AS bigint) AS size",
            "crc32(encode(coalesce(text, ''), 'UTF-8')) AS text_crc32",
        ),
        "shard-sizes",
    )
    ends = narrow.agg(
        *[f(c).alias(f"{n}_{i}") for i, c in enumerate(texts) for n, f in (("lo", F.min), ("hi", F.max))]
    ).first()
    codes = [text_code(f"`{c}`", ends[f"lo_{i}"], ends[f"hi_{i}"], bits) for i, c in enumerate(texts)]
    cells = narrow.selectExpr(
        "doc_id",
        "size",
        "text_crc32",
        *(f"{code} AS code_{i}" for i, code in enumerate([*codes, size_code("size", bits)])),
    )
    along = cells.select(
        "doc_id",
        "size",
        "text_crc32",
        curve_index([F.col(f"code_{i}") for i in range(len(codes) + 1)], bits).alias("curve_index"),
    )
    placed = ranked(in_order(along, "curve_index", "text_crc32", "doc_id", label="shard-order"))
    return placed.selectExpr(
        "doc_id",
        "size",
        "text_crc32",
        "curve_index",
        f"cast(_rank * {shards} div _rows AS int) AS shard",
        f"_rank - ((_rank * {shards} div _rows) * _rows + {shards - 1}) div {shards} AS slot",
    )
