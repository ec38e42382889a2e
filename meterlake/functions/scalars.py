"""Column functions: every one stays a built-in JVM expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake.schemas import COST_SAVED_PER_HIT

# Characters that separate words: the Unicode white space set plus the four
# ASCII separators. Java's \s alone covers only the ASCII part.
WHITESPACE_CLASS = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total_tokens(input_tokens="input_tokens", output_tokens="output_tokens") -> Column:
    return _col(input_tokens) + _col(output_tokens)


def safe_ratio(numerator, denominator) -> Column:
    """numerator / denominator, 0.0 when the denominator is 0 or null."""
    den = _col(denominator)
    return F.when(den != 0, _col(numerator) / den).otherwise(F.lit(0.0))


def cost_per_token(cost="cost_usd", tokens="total_tokens") -> Column:
    tok = _col(tokens)
    return F.when(tok > 0, _col(cost) / tok).otherwise(F.lit(0.0))


def event_date(timestamp="timestamp") -> Column:
    return F.to_date(_col(timestamp))


def micros(timestamp="timestamp") -> Column:
    """Microseconds since 1970 of a time without zone, whatever the session zone is."""
    ts = _col(timestamp)
    seconds = F.unix_date(F.to_date(ts)).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")


def from_micros(micros_column) -> Column:
    """Inverse of micros."""
    seconds = _col(micros_column).cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(6,6)")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def is_blank(text) -> Column:
    """True when the text holds nothing but white space."""
    return ~F.rlike(_col(text), F.lit(f"[^{WHITESPACE_CLASS}]"))


def whitespace_token_count(text) -> Column:
    """Number of white-space separated words of the whole text; 0 for blank text."""
    return F.regexp_count(_col(text), F.lit(f"[^{WHITESPACE_CLASS}]+"))


def _json_ascii(text: Column) -> Column:
    """A JSON string literal in which every character above 0x7e is \\uXXXX."""
    quoted = F.to_json(F.array(text))
    inner = F.substring(quoted, F.lit(3), F.length(quoted) - 4)

    def escape(run: Column) -> Column:
        utf16 = F.lower(F.hex(F.encode(run, "UTF-16BE")))
        return F.when(F.ascii(run).between(0x01, 0x7E), run).otherwise(
            F.regexp_replace(utf16, "(.{4})", r"\\u$1")
        )

    # Only texts with such characters are cut into runs and put together again.
    plain = ~F.rlike(text, F.lit(r"[^\t\n\r\x20-\x7e]"))
    runs = F.regexp_extract_all(inner, F.lit(r"[\x01-\x7e]+|[^\x01-\x7e]+"), F.lit(0))
    slow = F.array_join(F.transform(runs, escape), "")
    literal = F.concat(F.lit('"'), F.when(plain, inner).otherwise(slow), F.lit('"'))
    return F.coalesce(literal, F.lit("null"))


def cache_key(prefix: str, *parts, digits: int = 16) -> Column:
    """prefix:first hex digits (64 are all) of sha256 over the JSON array of the parts."""
    items = [_json_ascii(_col(p).cast("string")) for p in parts]
    body = F.concat(F.lit("["), F.concat_ws(", ", *items), F.lit("]"))
    key = F.concat(F.lit(prefix + ":"), F.substring(F.sha2(body, 256), 1, digits))
    # Never null, so a join on the key adds no null check that hashes the text again.
    return F.coalesce(key, F.lit(prefix + ":"))


def dimension(embedding="embedding") -> Column:
    return F.size(_col(embedding))


def mean_change_percent(historical="historical_mean", current="current_mean") -> Column:
    """Percent change of the mean; null when either mean is null or 0."""
    hist, cur = _col(historical), _col(current)
    return F.when((hist != 0) & (cur != 0), (cur - hist) / hist * 100)


def cost_saved(cache_hit="cache_hit") -> Column:
    return F.when(_col(cache_hit), F.lit(COST_SAVED_PER_HIT)).otherwise(F.lit(0.0))


def drift_detected(status="drift_status") -> Column:
    return _col(status) != "no_drift"


def stringify_value(value, is_complex: bool = False) -> Column:
    """Feature values are stored as strings; lists and maps as JSON."""
    return F.to_json(_col(value)) if is_complex else _col(value).cast("string")


def parse_numeric(value="value") -> Column:
    """Numeric feature value, null where the text is not a finite number."""
    number = F.expr(f"try_cast({value} AS DOUBLE)") if isinstance(value, str) else value.try_cast("double")
    infinite = F.abs(number) == F.lit(float("inf"))
    return F.when(F.isnan(number) | infinite, None).otherwise(number)


def parse_vector(value="value") -> Column:
    return F.from_json(_col(value), "array<float>")


def serialize_interaction(*columns) -> Column:
    """One JSON message with the given columns in their order."""
    # The default format of a time stops at milliseconds.
    options = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return F.to_json(F.struct(*columns), options)


def glob_to_regex(pattern: str) -> str:
    """Anchored regular expression for a key glob with *, ?, [..] and \\ escapes."""
    out, i = [], 0
    specials = set(".^$+{}()|\\*?[]-&~#/")
    while i < len(pattern):
        ch = pattern[i]
        if ch == "*":
            out.append("[\\s\\S]*")
        elif ch == "?":
            out.append("[\\s\\S]")
        elif ch == "[" and "]" in pattern[i + 1:]:
            end = pattern.index("]", i + 1)
            body = pattern[i + 1:end]
            negate = body.startswith("^")
            body = body[1:] if negate else body
            if body:
                safe = "".join("\\" + c if c in "\\^[]&" else c for c in body)
                out.append(("[^" if negate else "[") + safe + "]")
            else:
                out.append("[\\s\\S]" if negate else "(?!)")
            i = end
        else:
            if ch == "\\" and i + 1 < len(pattern):
                i += 1
                ch = pattern[i]
            out.append("\\" + ch if ch in specials else ch)
        i += 1
    return "\\A" + "".join(out) + "\\z"
