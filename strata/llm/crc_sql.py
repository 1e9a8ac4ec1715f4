"""CRC-32 as DuckDB SQL, for the oracles of queries that hash with it."""

#: The table of the reflected polynomial, as a common table expression with one row.
TABLE = """crc_table AS (
  SELECT list(list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc_of
  FROM range(256) AS t(i))"""


def crc32(text: str) -> str:
    """The CRC-32 of the UTF-8 bytes of ``text`` (code points below U+0800); crc_table has to be joined."""
    code = "unicode(c)"
    bytes_ = f"flatten(list_transform(list_filter(string_split({text}, ''), lambda c: c <> ''), lambda c: CASE WHEN {code} < 128 THEN [{code}::BIGINT] ELSE [(192 | ({code} >> 6))::BIGINT, (128 | ({code} & 63))::BIGINT] END))"
    return f"xor(list_reduce([4294967295] || {bytes_}, lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])), 4294967295)"
