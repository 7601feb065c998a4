"""Address arithmetic as column expressions.

An indicator is a bare address or a network of either family.  IPv4 bounds are BIGINT columns
``lo``/``hi``; IPv6 bounds are BINARY(16) columns ``lo6``/``hi6``, which compare bytewise in
address order.  Everything here runs inside the JVM; no row ever visits Python.

The expressions are SQL text over column names.  The long IPv6 ones are bound with :func:`_let`, a
lambda over a one-element array: they are evaluated for IPv6 rows only and stay out of the generated
code of the IPv4 path, which would otherwise grow past what the JVM compiles.
"""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import constants as K

ADDRESS_COLUMNS = ("indicator", "family", "is_net", "prefix", "lo", "hi", "lo6", "hi6")

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
V4_PATTERN = f"^{_OCTET}(?:[.]{_OCTET}){{3}}$"


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _pow2(exponent: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), exponent.cast("int"))


# ------------------------------------------------------------------ IPv4 text <-> number


def _v4_number_sql(text: str) -> str:
    number = " + ".join(
        f"try_cast(split_part({text}, '.', {i + 1}) as bigint) * {256 ** (3 - i)}L" for i in range(4)
    )
    return f"if({text} rlike '{V4_PATTERN}', {number}, null)"


def v4_number(text: str) -> Column:
    """Dotted quad -> BIGINT; NULL unless four octets <= 255 without leading zeros."""
    return F.expr(_v4_number_sql(text))


def v4_text(number: Column) -> Column:
    """BIGINT -> dotted quad."""
    return F.concat_ws(
        ".", *[F.shiftright(number, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    )


def _v4_prefix_sql(text: str) -> str:
    """Prefix from ``24``, ``255.255.255.0`` or ``0.0.0.255``; NULL if none of these."""
    mask = (
        "case when ((4294967295L - m) & (4294967296L - m)) = 0 then bit_count(m) "
        "when (m & (m + 1)) = 0 then 32 - bit_count(m) end"
    )
    by_mask = _let("m", _v4_number_sql(text), mask)
    plain = f"if(try_cast({text} as int) between 0 and 32, try_cast({text} as int), null)"
    return f"if({text} rlike '^[0-9]+$', {plain}, {by_mask})"


# ------------------------------------------------------------------ IPv6 text <-> bytes


def _v6_bytes_sql(text: str) -> str:
    """16 bytes of IPv6 ``text``; NULL if malformed."""
    pair = (
        "concat(substr(s, 1, length(s) - length(q)), lower(hex(shiftright(n, 16))), ':', "
        "lower(hex(n & 65535)))"
    )
    unquad = f"if(q = '', s, {_let('n', _v4_number_sql('q'), pair)})"
    quad = "regexp_extract(s, '^.*:([0-9]+[.][0-9]+[.][0-9]+[.][0-9]+)$', 1)"
    text_sql = _let("s", f"lower({text})", _let("q", quad, unquad))
    none = "cast(array() as array<string>)"
    sides = (
        "struct(u as t, locate('::', u) as at, "
        f"if(locate('::', u) > 0, substring_index(u, '::', 1), u) as l, "
        f"if(locate('::', u) > 0, substring_index(u, '::', -1), '') as r)"
    )
    groups = (
        f"struct(h.t, h.at, h.l, h.r, if(h.l = '', {none}, split(h.l, ':')) as lg, "
        f"if(h.r = '', {none}, split(h.r, ':')) as rg)"
    )
    shape = "^([0-9a-f]{1,4}(:[0-9a-f]{1,4})*)?$"
    count = "(size(g.lg) + size(g.rg))"
    valid = (
        f"g.t is not null and g.l rlike '{shape}' and g.r rlike '{shape}' and if(g.at > 0, "
        f"locate('::', substr(g.t, g.at + 1)) = 0 and {count} <= 7, {count} = 8)"
    )
    packed = (
        f"unhex(concat_ws('', transform(concat(g.lg, array_repeat('0', greatest(8 - {count}, 0)), "
        "g.rg), p -> lpad(p, 4, '0'))))"
    )
    body = _let("g", groups, f"if({valid}, {packed}, null)")
    return _let("u", text_sql, _let("h", sides, body))


def _v6_masked_sql(value: str, prefix: str, low: bool) -> str:
    """Bytes with the host bits cleared (``low``) or set: whole hex digits, one split digit, fill."""
    digit = f"cast(conv(substr(hex({value}), {prefix} div 4 + 1, 1), 16, 10) as bigint)"
    host = f"(shiftleft(1L, cast(4 - {prefix} % 4 as int)) - 1L)"
    split = f"hex({digit} - ({digit} & {host}))" if low else f"hex({digit} | {host})"
    fill = "0" if low else "F"
    return (
        f"if({prefix} >= 128, {value}, unhex(rpad(concat(substr(hex({value}), 1, cast({prefix} div 4 as int)), "
        f"if({prefix} % 4 = 0, '', {split})), 32, '{fill}')))"
    )


def v6_network(value: str, prefix: str) -> Column:
    """Bytes of column ``value`` with the host bits below ``prefix`` cleared."""
    return F.expr(_v6_masked_sql(value, prefix, True))


#: Zero groups between colons, the longest run first.
_ZERO_RUNS = [f":{'0:' * n}" for n in range(8, 1, -1)]


def _zeros_sql(framed: str) -> str:
    """The longest zero run of two or more groups in ``framed``, lower-case groups between colons; NULL if there is none."""
    runs = " ".join(f"when contains({framed}, '{r}') then '{r}'" for r in _ZERO_RUNS)
    return f"case when not contains({framed}, '{_ZERO_RUNS[-1]}') then null {runs} end"


def _shortened_sql(framed: str, zeros: str) -> str:
    """Text of ``framed`` groups with the first run ``zeros`` as ``::``, if that is not NULL."""
    return (
        f"if({zeros} is null, trim(':', {framed}), concat(if(locate({zeros}, {framed}) > 1, substr({framed}, 2, "
        f"locate({zeros}, {framed}) - 2), ''), '::', rtrim(':', substr({framed}, locate({zeros}, {framed}) + length({zeros})))))"
    )


def _v6_text_sql(value: str) -> str:
    """Canonical text: no leading zeros, the longest (first) zero run of two or more as ``::``."""
    groups = (
        "transform(array(0, 1, 2, 3, 4, 5, 6, 7), i -> "
        "regexp_replace(lower(hex(substr(v, 2 * i + 1, 2))), '^0{1,3}', ''))"
    )
    framed = f"concat(':', concat_ws(':', {groups}), ':')"
    text = _let("z", _zeros_sql("f"), _shortened_sql("f", "z"))
    return _let("v", value, _let("f", framed, text))


def v6_text(value: str) -> Column:
    return F.expr(_v6_text_sql(value))


# ------------------------------------------------------------------ whole entries


def fence(df: DataFrame, *columns: str) -> DataFrame:
    """Pass ``columns`` through a one-row generator, so that filters on them stay above it.

    A filter pushed below the projection that computes a column repeats the whole computation inside
    its condition; for parsed columns that is the dearest part of the job.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.array(F.struct(*columns))))


def with_address(df: DataFrame, text: str, accept: str = "entry") -> DataFrame:
    """Parse column ``text`` and add the address columns; ``indicator`` is NULL if malformed.

    ``accept``: ``"address"`` takes bare addresses only; ``"network"`` reads everything as a
    network (a bare address becomes /32 or /128, host bits are cleared); ``"entry"`` keeps a bare
    address as an address and reads the rest as a network.
    """
    if accept not in ("entry", "network", "address"):
        raise ValueError(f"unknown accept mode: {accept}")
    keep = [F.col(f"`{c}`") for c in df.columns]
    width = "case when _v4 is not null then 32 when _v6 is not null then 128 end"
    given = (
        "null"
        if accept == "address"
        else f"case when _v4 is not null then {_v4_prefix_sql('_len')} when _v6 is not null and "
        "_len rlike '^[0-9]+$' and try_cast(_len as int) <= 128 then try_cast(_len as int) end"
    )
    host = "(shiftleft(1L, 32 - _plen) - 1L)"
    is_net = "true" if accept == "network" else "_len is not null"
    split = df.select(
        *keep,
        F.expr(f"substring_index(`{text}`, '/', 1)").alias("_addr"),
        F.expr(f"if(instr(`{text}`, '/') > 0, substr(`{text}`, instr(`{text}`, '/') + 1), null)").alias(
            "_len"
        ),
    )
    read = split.select(
        *keep,
        "_addr",
        "_len",
        F.expr(_v4_number_sql("_addr")).alias("_v4"),
        F.expr(f"if(instr(_addr, ':') > 0, {_v6_bytes_sql('_addr')}, null)").alias("_v6"),
    )
    sized = read.select(
        *keep,
        "_addr",
        "_v4",
        "_v6",
        F.expr(f"cast(if(_len is null, {width}, {given}) as int)").alias("_plen"),
        F.expr(is_net).alias("_net"),
    )
    bounded = sized.select(
        *keep,
        "_addr",
        F.expr(
            "cast(case when _plen is null then null when _v4 is not null then 4 else 6 end as tinyint)"
        ).alias("family"),
        F.expr("if(_plen is null, null, _net)").alias("is_net"),
        F.expr("if(_net, _plen, null)").alias("prefix"),
        F.expr(f"if(_plen is null, null, _v4 - (_v4 & {host}))").alias("lo"),
        F.expr(f"if(_plen is null, null, _v4 | {host})").alias("hi"),
        F.expr(
            f"if(_plen is null or _v6 is null, null, {_v6_masked_sql('_v6', '_plen', True)})"
        ).alias("lo6"),
        F.expr(
            f"if(_plen is null or _v6 is null, null, {_v6_masked_sql('_v6', '_plen', False)})"
        ).alias("hi6"),
    )
    rendered = F.when(
        F.col("family") == 4, F.when(F.col("is_net"), v4_text(F.col("lo"))).otherwise(F.col("_addr"))
    ).when(F.col("family") == 6, v6_text("lo6"))
    tail = F.when(F.col("is_net"), F.concat(F.lit("/"), F.col("prefix").cast("string"))).otherwise("")
    others = [c for c in ADDRESS_COLUMNS if c != "indicator"]
    named = bounded.select(*keep, F.concat(rendered, tail).alias("indicator"), *others)
    return fence(named, *ADDRESS_COLUMNS)


def v4_network_columns(low: Column, prefix: Column) -> dict[str, Column]:
    """Address columns of an IPv4 network given by number, without going through text."""
    none = F.lit(None).cast("binary")
    return {
        "indicator": F.concat(v4_text(low), F.lit("/"), prefix.cast("string")),
        "family": F.lit(4).cast("tinyint"),
        "is_net": F.lit(True),
        "prefix": prefix.cast("int"),
        "lo": low,
        "hi": low + _pow2(F.lit(32) - prefix) - F.lit(1),
        "lo6": none,
        "hi6": none,
    }


def network_prefix() -> Column:
    """Prefix length of the entry read as a network."""
    return F.coalesce(F.col("prefix"), F.when(F.col("family") == 4, 32).otherwise(128))


def address_family() -> Column:
    return F.concat(F.lit("v"), F.col("family").cast("string"))


def sort_key() -> list[Column]:
    """Total order of entries: family, numeric address, prefix (128 for a bare address)."""
    return [
        F.col("family").asc(),
        F.col("lo").asc_nulls_last(),
        F.col("lo6").asc_nulls_last(),
        F.coalesce(F.col("prefix"), F.lit(128)).asc(),
    ]


# ------------------------------------------------------------------ sizes


def _capped_size(bits: Column, cap_bits: int) -> Column:
    return _pow2(F.least(bits, F.lit(cap_bits)))


def entry_weight() -> Column:
    """Addresses covered by an entry, a bare address counting one, at most 2**24."""
    bits = F.when(F.col("family") == 4, 32).otherwise(128) - network_prefix()
    return F.when(F.col("is_net"), F.least(_capped_size(bits, 24), F.lit(K.MAX_ENTRY_WEIGHT))).otherwise(
        F.lit(1).cast("bigint")
    )


def network_weight() -> Column:
    """Weight of an entry in per-network rollups."""
    return F.least(entry_weight(), F.lit(K.MAX_NETWORK_WEIGHT))


def subnets_64() -> Column:
    """Scope of an entry: IPv4 addresses, or IPv6 /64 subnets; DECIMAL because sums pass 2**63."""
    bits = F.greatest(F.lit(64) - network_prefix(), F.lit(0))
    half = F.least(bits, F.lit(32))
    d20 = "decimal(20,0)"
    v6 = (_pow2(half).cast(d20) * _pow2(bits - half).cast(d20)).cast(d20)
    v4 = _capped_size(F.lit(32) - network_prefix(), 32)
    return (
        F.when(~F.col("is_net"), F.lit(1).cast("decimal(20,0)"))
        .when(F.col("family") == 4, v4.cast("decimal(20,0)"))
        .otherwise(v6)
    )


def sites_48() -> Column:
    """IPv6 /48 sites covered by an entry."""
    return _capped_size(F.greatest(F.lit(48) - network_prefix(), F.lit(0)), 48)


# ------------------------------------------------------------------ classification


def _literal(address: ipaddress.IPv4Address | ipaddress.IPv6Address) -> str:
    return f"{int(address)}L" if address.version == 4 else f"X'{address.packed.hex()}'"


def _bounds(cidr: str) -> tuple[str, str]:
    net = ipaddress.ip_network(cidr)
    return _literal(net.network_address), _literal(net.broadcast_address)


def _joined(cidrs: tuple[str, ...]) -> list[tuple]:
    """First and last addresses of the spans that ``cidrs`` make up, touching networks being one span."""
    spans: list[list] = []
    for net in sorted(map(ipaddress.ip_network, cidrs)):
        if spans and int(net.network_address) <= int(spans[-1][1]) + 1:
            spans[-1][1] = max(spans[-1][1], net.broadcast_address)
        else:
            spans.append([net.network_address, net.broadcast_address])
    return [tuple(span) for span in spans]


def _point_in(point: str, cidrs: tuple[str, ...]) -> str:
    spans = [tuple(map(_literal, span)) for span in _joined(cidrs)]
    return "(" + " or ".join(f"({point} >= {lo} and {point} <= {hi})" for lo, hi in spans) + ")"


def _span_in(low: str, high: str, cidrs: tuple[str, ...]) -> str:
    spans = [_bounds(c) for c in cidrs]
    return "(" + " or ".join(f"({low} >= {lo} and {high} <= {hi})" for lo, hi in spans) + ")"


def _special(lo: str, hi: str, private, private_except, reserved, multicast) -> str:
    exempt = f"({_point_in(lo, private_except)} or {_point_in(hi, private_except)})"
    return (
        f"(({_span_in(lo, hi, private)} and not {exempt}) "
        f"or ({_point_in(lo, reserved)} and {_point_in(hi, reserved)}) "
        f"or {_span_in(lo, hi, multicast)})"
    )


def is_global() -> Column:
    """False for private, loopback, link-local, reserved and multicast space.

    A network is special only if both of its ends are.
    """
    v4 = _special(
        "lo", "hi", K.V4_PRIVATE, K.V4_PRIVATE_EXCEPT, K.V4_RESERVED, K.V4_MULTICAST
    )
    v6 = _special(
        "e.a", "e.b", K.V6_PRIVATE, K.V6_PRIVATE_EXCEPT, K.V6_RESERVED, K.V6_MULTICAST
    )
    ends = "struct(lo6 as a, hi6 as b)"
    # Most entries lie in the widest span without special networks, which two comparisons tell.
    spans = _joined(K.V6_PRIVATE + K.V6_RESERVED + K.V6_MULTICAST)
    below, above = max(zip(spans, spans[1:]), key=lambda pair: int(pair[1][0]) - int(pair[0][1]))
    plain = f"lo6 >= {_literal(below[1] + 1)} and hi6 <= {_literal(above[0] - 1)}"
    return F.expr(f"not if(family = 4, {v4}, not ({plain}) and {_let('e', ends, v6)})")


# ------------------------------------------------------------------ blocks and buckets


def unicast_block() -> Column:
    """The /12 an IPv6 entry starts in, as text."""
    group = F.concat(F.substring(F.lower(F.hex("lo6")), 1, 3), F.lit("0"))
    short = F.regexp_replace(group, "^0+", "")
    return F.when(
        F.col("family") == 6, F.concat(short, F.lit("::/12"))
    )


def allocation_key() -> Column:
    """Allocation an entry belongs to: IPv4 /16 or IPv6 /32 number."""
    return F.when(F.col("family") == 4, F.shiftright("lo", 16)).otherwise(
        F.conv(F.hex(F.substring("lo6", 1, 4)), 16, 10).cast("bigint")
    )


def spectrum_buckets() -> Column:
    """Array of the equal slices of IPv4 space an entry touches."""
    span = (1 << 32) // K.SPECTRUM_BUCKETS
    return F.sequence(
        F.floor(F.col("lo") / F.lit(span)).cast("int"), F.floor(F.col("hi") / F.lit(span)).cast("int")
    )


def _words6(value: Column) -> list[Column]:
    return [
        F.conv(F.hex(F.substring(value, 1 + 4 * i, 4)), 16, 10).cast("bigint") for i in range(4)
    ]


def v6_decimal_text(value: Column) -> Column:
    """128-bit value as decimal text.

    2**64 = 1844674407 * 10**10 + 3709551616 keeps every partial product inside DECIMAL(38,0).
    """
    w = _words6(value)
    d20 = "decimal(20,0)"
    high = (w[0].cast(d20) * F.lit(1 << 32) + w[1].cast(d20)).cast(d20)
    low = (w[2].cast(d20) * F.lit(1 << 32) + w[3].cast(d20)).cast(d20)
    upper = (high * F.lit(1844674407).cast("decimal(10,0)")).cast("decimal(38,0)")
    lower = (high * F.lit(3709551616).cast("decimal(10,0)") + low).cast("decimal(38,0)")
    ten10 = F.lit(10**10).cast("decimal(11,0)")
    rest = (lower % ten10).cast("decimal(11,0)")
    top = (upper + ((lower - rest) / ten10).cast("decimal(38,0)")).cast("decimal(38,0)")
    return F.when(top == 0, rest.cast("string")).otherwise(
        F.concat(top.cast("string"), F.lpad(rest.cast("string"), 10, "0"))
    )


# ------------------------------------------------------------------ ranges to networks


def cover_v4_range(df: DataFrame, start: str, end: str) -> DataFrame:
    """Cut every inclusive IPv4 range into its minimal network cover.

    For each block size the first and the last aligned block inside the range are candidates; a
    candidate belongs to the cover when it fits and its parent block does not.  At most 62 rows
    come out of one range, added as ``block_lo`` and ``block_prefix``.
    """

    top = F.floor(F.log2(F.col(end) - F.col(start) + F.lit(1))).cast("int")
    levels = df.select("*", F.explode(F.sequence(F.lit(0), top)).alias("_k"))
    size = _pow2(F.col("_k"))
    low, high = F.col(start), F.col(end)
    up = low + size - F.lit(1)
    down = high + F.lit(1)
    placed = levels.withColumns(
        {"_size": size, "_first": up - up % size, "_last": down - down % size - size}
    )

    def block(at: str, wanted: Column) -> Column:
        span = F.col("_size") * F.lit(2)
        parent = F.col(at) - F.col(at) % span
        fits = (F.col(at) >= low) & (F.col(at) + F.col("_size") - F.lit(1) <= high)
        parent_fits = (parent >= low) & (parent + span - F.lit(1) <= high) & (F.col("_k") < 32)
        return F.when(wanted & fits & ~parent_fits, F.col(at))

    first = block("_first", F.lit(True))
    last = block("_last", F.col("_last") != F.col("_first"))
    return (
        placed.select(
            *df.columns,
            (F.lit(32) - F.col("_k")).cast("int").alias("block_prefix"),
            F.explode(F.array(first, last)).alias("block_lo"),
        )
        .filter("block_lo is not null")
        .select(*df.columns, "block_lo", "block_prefix")
    )


def _low_ones_sql(bits: str) -> tuple[str, str]:
    """The upper and the lower half of the 128-bit number whose low ``bits`` digits are ones."""
    upper = f"case when {bits} <= 64 then 0L when {bits} < 128 then ~shiftleft(-1L, {bits} - 64) else -1L end"
    return upper, f"if({bits} < 64, ~shiftleft(-1L, {bits}), -1L)"


def with_range_networks(df: DataFrame, start: str, end: str) -> DataFrame:
    """Cut inclusive address ranges of either family into their minimal network covers, one row a network.

    ``start`` and ``end`` are text columns; rows without a readable range come out once with NULL address columns.  Addresses
    are pairs of BIGINT halves (``h``, ``l``), on which everything is shifts and masks in generated code.  Of ends that differ
    in their low ``_n`` bits only, each side has one candidate block for each of these bits (at most 256 a range).  Seen from
    the start, block ``k`` is in the cover if bit ``k``, or the highest of the ``_n``, is a one above zeros alone or a zero
    above some one; the end is the same with its bits turned over.
    """
    keep = [F.col(f"`{c}`") for c in df.columns]
    ends = df.select(
        *keep,
        *[F.expr(_v4_number_sql(f"`{c}`")).alias(f"_{k}4") for k, c in (("a", start), ("b", end))],
        *[
            F.expr(f"if(instr(`{c}`, ':') > 0, {_v6_bytes_sql(f'`{c}`')}, null)").alias(f"_{k}6")
            for k, c in (("a", start), ("b", end))
        ],
    )
    sized = fence(
        ends.withColumn("_w", F.expr("case when _a4 <= _b4 then 32 when _a6 <= _b6 then 128 end")),
        "_a4", "_b4", "_a6", "_b6", "_w",
    )
    half = "cast(conv(hex(substr(_{0}6, {1}, 8)), 16, -10) as bigint)"
    halves = sized.select(
        *keep,
        "_w",
        *[F.expr(f"case _w when 32 then 0L when 128 then {half.format(k, 1)} end").alias(f"_{k}h") for k in "ab"],
        *[F.expr(f"case _w when 32 then _{k}4 when 128 then {half.format(k, 9)} end").alias(f"_{k}l") for k in "ab"],
    )
    differ = "if(_ah <> _bh, 64 + length(bin(_ah ^ _bh)), if(_al <> _bl, length(bin(_al ^ _bl)), 0))"
    spread = fence(halves.withColumn("_n", F.expr(differ)), "_w", "_ah", "_al", "_bh", "_bl", "_n")
    high, low = _low_ones_sql("_n")
    # One network: everything below the shared bits is in the range.
    whole = f"((_ah | ~_bh) & {high}) = 0 and ((_al | ~_bl) & {low}) = 0"
    sides = spread.select(
        *keep, "_w", "_ah", "_al", "_bh", "_bl", "_n",
        F.explode(F.expr(f"if(_w is null or {whole}, array(-1), sequence(0, 2 * _n - 1))")).alias("_j"),
    )
    high, low = _low_ones_sql("_k")
    seen = sides.select(
        *keep, "_w", "_ah", "_al", "_bh", "_bl", "_n", "_j",
        F.expr("shiftright(_j, 1) = _n - 1").alias("_top"),
        F.expr("shiftright(_j, 1)").alias("_k"),
        *[F.expr(f"if((_j & 1) = 0, _a{k}, ~_b{k})").alias(f"_c{k}") for k in "hl"],
    )
    masked = seen.withColumns({"_mh": F.expr(high), "_ml": F.expr(low)})
    placed = masked.withColumns(
        {
            "_one": F.expr("_top or (shiftright(if(_k < 64, _cl, _ch), _k & 63) & 1) = 1"),
            "_bare": F.expr("(_ch & _mh) = 0 and (_cl & _ml) = 0"),
            "_xh": F.expr("_ch & ~_mh | if(_top or _k < 64, 0L, shiftleft(1L, _k - 64))"),
            "_xl": F.expr("_cl & ~_ml | if(_top or _k >= 64, 0L, shiftleft(1L, _k))"),
        }
    )
    bounds = ("lh", "ll", "uh", "ul", "bits")

    def block(*values: str) -> str:
        return f"array(named_struct({', '.join(f"""'_{b}', {v}""" for b, v in zip(bounds, values))}))"

    found = (
        f"case when _j < 0 then {block('_ah', '_al', '_bh', '_bl', '_n')} when _one <> _bare then null "
        f"when (_j & 1) = 0 then {block('_xh', '_xl', '_xh | _mh', '_xl | _ml', '_k')} "
        f"else {block('~(_xh | _mh)', '~(_xl | _ml)', '~_xh', '~_xl', '_k')} end"
    )
    each = placed.select(*keep, "_w", F.inline(F.expr(found)))
    packed = "if(_w = 128, unhex(concat(lpad(hex(_{0}h), 16, '0'), lpad(hex(_{0}l), 16, '0'))), null)"
    groups = ", ".join(f"hex(shiftright(_l{h}, {s}) & 65535L)" for h in "hl" for s in (48, 32, 16, 0))
    named = each.select(
        *keep,
        F.expr("cast(case _w when 32 then 4 when 128 then 6 end as tinyint)").alias("family"),
        F.expr("_w is not null or null").alias("is_net"),
        F.expr("_w - _bits").alias("prefix"),
        *[F.expr(f"if(_w = 32, _{k}l, null)").alias(c) for k, c in (("l", "lo"), ("u", "hi"))],
        *[F.expr(packed.format(k)).alias(c) for k, c in (("l", "lo6"), ("u", "hi6"))],
        F.expr(f"if(_w = 128, concat(':', lower(concat_ws(':', {groups})), ':'), null)").alias("_framed"),
    )
    named = named.withColumn("_zeros", F.expr(_zeros_sql("_framed")))
    text = F.when(F.col("family") == 4, v4_text(F.col("lo"))).when(
        F.col("family") == 6, F.expr(_shortened_sql("_framed", "_zeros"))
    )
    indicator = F.concat(text, F.lit("/"), F.col("prefix").cast("string")).alias("indicator")
    return fence(named.select(*keep, indicator, *ADDRESS_COLUMNS[1:]), *ADDRESS_COLUMNS)
