"""CRC-32 in DuckDB SQL, for the oracles of operators whose contract names it."""

# One row, column ``crc_of``: the remainder of each byte (polynomial 0xEDB88320, reflected).
TABLE = ("SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) "
         "ORDER BY i) AS crc_of FROM (SELECT unnest(range(256)) AS i)")


def crc32(text: str, table: str = "crc_of") -> str:
    """SQL expression of a text's CRC-32 over its UTF-8 bytes (``table``: the column of :data:`TABLE`)."""
    digits = f"hex(encode({text}))"
    octets = f"list_transform(range(length({digits}) // 2), lambda k: ('0x' || substr({digits}, (2 * k + 1)::BIGINT, 2))::BIGINT)"
    return f"xor(list_reduce({octets}, lambda c, b: xor({table}[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295)"
