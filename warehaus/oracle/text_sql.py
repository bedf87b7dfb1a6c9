"""SQL formulation of clean_text: tokenise the byte-per-character text into
valid UTF-8 sequences and decode each one arithmetically."""

from __future__ import annotations

from warehaus.functions.text import CP1252_HIGH_BYTES, CP1252_HIGH_CHARS

_KEEP = "".join(f"\\x{{{ord(c):X}}}" for c in CP1252_HIGH_CHARS)
_BYTES = "".join(chr(b) for b in CP1252_HIGH_BYTES)

# Well-formed UTF-8 sequences written over characters U+0000-U+00FF (one per byte).
_SEQ = ("(?s)("
        "[\\x{C2}-\\x{DF}][\\x{80}-\\x{BF}]"
        "|\\x{E0}[\\x{A0}-\\x{BF}][\\x{80}-\\x{BF}]"
        "|[\\x{E1}-\\x{EC}\\x{EE}\\x{EF}][\\x{80}-\\x{BF}]{2}"
        "|\\x{ED}[\\x{80}-\\x{9F}][\\x{80}-\\x{BF}]"
        "|\\x{F0}[\\x{90}-\\x{BF}][\\x{80}-\\x{BF}]{2}"
        "|[\\x{F1}-\\x{F3}][\\x{80}-\\x{BF}]{3}"
        "|\\x{F4}[\\x{80}-\\x{8F}][\\x{80}-\\x{BF}]{2}"
        "|.)")


def clean_text_sql(expr: str) -> str:
    bytes_text = (f"translate(regexp_replace({expr}, '[^\\x{{0}}-\\x{{7F}}\\x{{A0}}-\\x{{FF}}{_KEEP}]', '', 'g'), "
                  f"'{CP1252_HIGH_CHARS}', '{_BYTES}')")
    decode = ("CASE length(t) "
              "WHEN 1 THEN CASE WHEN unicode(t) < 128 THEN t ELSE '' END "
              "WHEN 2 THEN chr(((unicode(t[1]) & 31) << 6) | (unicode(t[2]) & 63)) "
              "WHEN 3 THEN chr(((unicode(t[1]) & 15) << 12) | ((unicode(t[2]) & 63) << 6) "
              "| (unicode(t[3]) & 63)) "
              "ELSE chr(((unicode(t[1]) & 7) << 18) | ((unicode(t[2]) & 63) << 12) "
              "| ((unicode(t[3]) & 63) << 6) | (unicode(t[4]) & 63)) END")
    return (f"coalesce(array_to_string(list_transform(regexp_extract_all({bytes_text}, '{_SEQ}'), "
            f"lambda t: {decode}), ''), '')")


# Well-formed sequences, else single bytes.
_UNITS = ("(?s)("
          "[\\x{C2}-\\x{DF}][\\x{80}-\\x{BF}]"
          "|\\x{E0}[\\x{A0}-\\x{BF}][\\x{80}-\\x{BF}]"
          "|[\\x{E1}-\\x{EC}\\x{EE}\\x{EF}][\\x{80}-\\x{BF}]{2}"
          "|\\x{ED}[\\x{80}-\\x{9F}][\\x{80}-\\x{BF}]"
          "|\\x{F0}[\\x{90}-\\x{BF}][\\x{80}-\\x{BF}]{2}"
          "|[\\x{F1}-\\x{F3}][\\x{80}-\\x{BF}]{3}"
          "|\\x{F4}[\\x{80}-\\x{8F}][\\x{80}-\\x{BF}]{2}"
          "|.)")


def latin1_misread_sql(expr: str) -> str:
    """Text written as ISO-8859-1 (unmappable -> '?') and read back as UTF-8,
    each byte outside a well-formed sequence replaced by '?'."""
    latin1 = f"regexp_replace({expr}, '[^\\x{{0}}-\\x{{FF}}]', '?', 'g')"
    well_formed = (
        "(length(t) = 2 AND unicode(t[1]) BETWEEN 194 AND 223) "
        "OR (length(t) = 3 AND ((unicode(t[1]) = 224 AND unicode(t[2]) >= 160) "
        "OR (unicode(t[1]) BETWEEN 225 AND 239 AND unicode(t[1]) <> 237) "
        "OR (unicode(t[1]) = 237 AND unicode(t[2]) < 160))) "
        "OR (length(t) = 4 AND ((unicode(t[1]) = 240 AND unicode(t[2]) >= 144) "
        "OR unicode(t[1]) BETWEEN 241 AND 243 OR (unicode(t[1]) = 244 AND unicode(t[2]) < 144)))")
    decode = ("CASE WHEN length(t) = 1 THEN CASE WHEN unicode(t) < 128 THEN t ELSE '?' END "
              f"WHEN NOT ({well_formed}) THEN '?' "
              "WHEN length(t) = 2 THEN chr(((unicode(t[1]) & 31) << 6) | (unicode(t[2]) & 63)) "
              "WHEN length(t) = 3 THEN chr(((unicode(t[1]) & 15) << 12) | ((unicode(t[2]) & 63) << 6) "
              "| (unicode(t[3]) & 63)) "
              "ELSE chr(((unicode(t[1]) & 7) << 18) | ((unicode(t[2]) & 63) << 12) "
              "| ((unicode(t[3]) & 63) << 6) | (unicode(t[4]) & 63)) END")
    return (f"array_to_string(list_transform(regexp_extract_all({latin1}, '{_UNITS}'), "
            f"lambda t: {decode}), '')")
