"""Text scalars as column expressions: cleaning, keys, dates, codes, amounts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keywords import Scan

SPACE = "(?U)\\s+"


def words(*items: str) -> Column:
    """An array of literals."""
    return F.array(*[F.lit(x) for x in items]) if items else F.array().cast("array<string>")


def hits(text: Column | Scan, keywords: Iterable[str]) -> Column:
    """Keywords that the text contains, in the rules' order."""
    if isinstance(text, Scan):
        return text.hits(keywords)
    return F.filter(words(*keywords), lambda k: F.contains(text, k))


def n_hits(text: Column | Scan, keywords: Iterable[str]) -> Column:
    """How many of the keywords the text contains."""
    return F.size(hits(text, keywords))


def any_hit(text: Column | Scan, keywords: Iterable[str]) -> Column:
    """Whether the text contains one of the keywords."""
    if isinstance(text, Scan):
        return text.any_hit(keywords)
    out = F.lit(False)
    for k in keywords:
        out = out | F.contains(text, F.lit(k))
    return out


def first_label(text: Column | Scan, rules: Iterable[tuple[str, Iterable[str]]], default: str) -> Column:
    """Label of the first rule with a keyword in the text."""
    return F.coalesce(*[F.when(any_hit(text, ks), label) for label, ks in rules], F.lit(default))


def best_rule(text: Column | Scan, rules: dict[str, Iterable[str]], default: str) -> Column:
    """struct(label, hits) of the rule with the most keywords in the text; ties go to the earlier, none to the default without hits."""
    none = F.struct(F.lit(default).alias("label"), F.array().cast("array<string>").alias("hits"))
    if not rules:
        return none
    found = [F.struct((-F.size(h)).alias("n"), F.lit(i).alias("i"), F.lit(label).alias("label"), h.alias("hits")) for i, (label, h) in enumerate((k, hits(text, ks)) for k, ks in rules.items())]
    best = F.array_min(F.array(*found))
    return F.when(best["n"] < 0, F.struct(best["label"].alias("label"), best["hits"].alias("hits"))).otherwise(none)


def best_label(text: Column | Scan, rules: dict[str, Iterable[str]], default: str) -> Column:
    """Label with the most keywords in the text; ties go to the earlier rule, none to the default."""
    return best_rule(text, rules, default)["label"]


def canonical(text: Column) -> Column:
    """Lowered text without white space and punctuation."""
    return F.lower(F.translate(F.regexp_replace(text, SPACE, ""), "，。、“”‘’!！?？:：;；,.", ""))


def dedup_key(title: Column, content: Column) -> Column:
    """12 hex digits that equal documents share."""

    def first(text: Column, n: int) -> Column:
        """The first n canonical characters; the whole text is cleaned only if its beginning has too few."""
        begin = canonical(F.substring(text, 1, 2 * n))
        return F.substring(F.when((F.length(begin) > n) | (F.length(text) <= 2 * n), begin).otherwise(canonical(text)), 1, n)

    return F.substring(F.md5(F.concat(first(title, 80), F.lit("::"), first(content, 160)).cast("binary")), 1, 12)


def sanitized(text: Column) -> Column:
    """Text without control characters other than tab and line ends."""
    return F.regexp_replace(text, "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]", "")


def normalized_time(text: Column) -> Column:
    """Timestamp from one of three formats, else null."""
    t = F.trim(text)
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd")])


def normalized_date(text: Column) -> Column:
    """Date from one of four formats, else null."""
    t = F.trim(text)
    return F.to_date(F.coalesce(*[F.try_to_timestamp(t, F.lit(f)) for f in ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd", "yyyy-MM-dd HH:mm:ss")]))


def without_tags(html: Column) -> Column:
    """Text of HTML: scripts, styles and tags out, common references decoded, white space collapsed."""
    out = F.regexp_replace(html, "(?is)<(script|style)\\b.*?</\\1>", " ")
    out = F.regexp_replace(out, "(?s)<[^>]+>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(out, SPACE, " "))


def list_items(text: Column, breaks: str = "[,，|;；、]") -> Column:
    """Items of a JSON list, or of text split at separators; trimmed, without blanks."""
    parsed = F.from_json(text, "array<string>")
    items = F.when(F.trim(text).startswith("["), parsed).otherwise(F.split(text, breaks))
    return F.filter(F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != "")


def first_filled(*texts: Column) -> Column:
    """The first text that isn't null or blank, trimmed; else the empty text."""
    return F.coalesce(*[F.nullif(F.trim(t), F.lit("")) for t in texts], F.lit(""))


def exchange_of(code: Column) -> Column:
    """Exchange of a six-digit code by its prefix."""
    return F.when(code.rlike("^(60|68|90)\\d{4}$"), "SH").when(code.rlike("^(00|20|30)\\d{4}$"), "SZ").when(code.rlike("^(4|8|92)\\d+$"), "BJ").otherwise("")


def listing_code(code: Column) -> Column:
    """Six digits with the exchange as suffix."""
    return F.when(exchange_of(code) != "", F.concat(code, F.lit("."), exchange_of(code))).otherwise(code)


def quote_symbols(listing: Column) -> Column:
    """struct(prefixed, numbered): a listing code in the forms that two quote services use."""
    code, suffix = F.substring_index(listing, ".", 1), F.lower(F.substring_index(listing, ".", -1))
    return F.struct(F.concat(suffix, code).alias("prefixed"), F.concat(F.when(suffix == "sh", "1.").otherwise("0."), code).alias("numbered"))


# Units of amounts, in yuan; the third and the order of the pattern are as published.
UNITS = {"万亿": 1e12, "亿港元": 0.92e8, "亿元": 1e8, "亿": 1e8, "千万元": 1e8, "百万元": 1e6, "万元": 1e4, "万港元": 0.92e4, "港元": 0.92, "美元": 7.2, "亿美元": 7.2e8}
AMOUNT = "(\\d+(?:\\.\\d+)?)\\s*(" + "|".join(UNITS) + ")"


def amounts(text: Column, pattern: str) -> Column:
    """array of struct(n, u): numbers and units by a pattern of two groups without anchors; the text is read once, its groups come from the matches."""
    part = lambda x, k: F.regexp_extract(x, pattern, k)
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.struct(part(x, 1).cast("double").alias("n"), part(x, 2).alias("u")))


def amount_yuan(text: Column) -> Column:
    """The largest amount of money that the text names, in yuan."""
    rate = F.create_map(*[F.lit(x) for pair in UNITS.items() for x in pair])
    return F.array_max(F.transform(amounts(text, AMOUNT), lambda x: x["n"] * F.element_at(rate, x["u"])))


def amount_log(text: Column) -> Column:
    """log10(amount + 1), 6 digits."""
    return F.round(F.log10(amount_yuan(text) + 1), 6)


def chunks(text: Column, size: int) -> Column:
    """Lines packed in order into pieces of at most ``size`` characters; a longer line is its own piece."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def add(acc, line):
        joined = F.when(acc["open"] == "", line).otherwise(F.concat_ws("\n", acc["open"], line))
        fits = F.length(joined) <= size
        full = F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"])))
        return F.struct(F.when(fits, acc["done"]).otherwise(full).alias("done"), F.when(fits, joined).otherwise(line).alias("open"))

    return F.aggregate(lines, start, add, lambda acc: F.when(acc["open"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays, with 1e-8 in the divisor."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + 1e-8)


# -- times of list pages; ``now`` is a parameter


def _stamp(t: Column) -> Column:
    return F.date_format(t, "yyyy-MM-dd HH:mm:ss")


def _this_year_or_last(month_day_time: Column, now: str) -> Column:
    """A time without a year: this year's, or last year's if that is over a day ahead."""
    at = F.lit(now).cast("timestamp")
    this = F.try_to_timestamp(F.concat(F.year(at).cast("string"), F.lit("-"), month_day_time), F.lit("yyyy-MM-dd HH:mm"))
    last = F.try_to_timestamp(F.concat((F.year(at) - 1).cast("string"), F.lit("-"), month_day_time), F.lit("yyyy-MM-dd HH:mm"))
    return F.when(this > at + F.expr("INTERVAL 1 DAY"), last).otherwise(this)


def relative_time(value: Column, now: str, minutes: str = "分钟前", hours: str = "小时前") -> Column:
    """Time as text from "n minutes ago", "n hours ago", month and day, or a full time; else now."""
    v = F.trim(F.coalesce(value, F.lit("")))
    at = F.lit(now).cast("timestamp")
    back = lambda unit, seconds: F.when(v.rlike(f"^[0-9]{{1,2}}{unit}$"), F.timestamp_seconds(F.unix_timestamp(at) - F.regexp_extract(v, "^([0-9]+)", 1).try_cast("int") * seconds))
    short = F.when(v.rlike("^[0-9]{2}-[0-9]{2}\\s+[0-9]{2}:[0-9]{2}$"), _this_year_or_last(F.regexp_replace(v, "\\s+", " "), now))
    full = F.when(v.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}\\s+[0-9]{2}:[0-9]{2}$"), F.try_to_timestamp(F.regexp_replace(v, "\\s+", " "), F.lit("yyyy-MM-dd HH:mm")))
    return _stamp(F.coalesce(back(minutes, 60), back(hours, 3600), short, full, at))


def yearless_time(value: Column, now: str, month: str = "月", day: str = "日") -> Column:
    """Time as text from a month, day and clock somewhere in a text; else now."""
    pattern = f"([0-9]{{2}}){month}([0-9]{{2}}){day}\\s+([0-9]{{2}}:[0-9]{{2}})"
    v = F.coalesce(value, F.lit(""))
    found = F.when(F.rlike(v, F.lit(pattern)), F.concat(F.regexp_extract(v, pattern, 1), F.lit("-"), F.regexp_extract(v, pattern, 2), F.lit(" "), F.regexp_extract(v, pattern, 3)))
    return _stamp(F.coalesce(_this_year_or_last(found, now), F.lit(now).cast("timestamp")))


def time_or_now(value: Column, fmt: str, now: str) -> Column:
    """A time by a format, else now, as text."""
    return _stamp(F.coalesce(F.try_to_timestamp(F.trim(value), F.lit(fmt)), F.lit(now).cast("timestamp")))


def strict_time(value: Column) -> Column:
    """A timestamp from one of three formats; anything else is an error."""
    t = normalized_time(value)
    return F.when(t.isNotNull(), t).otherwise(F.raise_error(F.concat(F.lit("unsupported time: "), F.coalesce(value, F.lit("null")))).cast("timestamp"))


def valid_json(value: Column, default: str) -> Column:
    """A JSON text, or the default where it can't be read."""
    return F.when(F.try_parse_json(value).isNotNull(), value).otherwise(default)


def allowed(value: Column, labels: Iterable[str], default: str) -> Column:
    """A label of a fixed list, else the default."""
    return F.when(value.isin(*labels), value).otherwise(default)


def anchored(text: Column, rules: Iterable[tuple[str, Iterable[str]]], current: Column) -> Column:
    """The first label with a word in the text, else what is there."""
    return F.coalesce(*[F.when(any_hit(text, ks), label) for label, ks in rules], current)


def channel(source_type: Column, source: Column, rules: Iterable[tuple[str, Iterable[str]]], known: Iterable[str], default: str) -> Column:
    """The channel of a source: by a word in its type or name, else a known type, else the default."""
    t = F.trim(F.coalesce(source_type, F.lit("")))
    both = F.concat_ws(" ", F.coalesce(source_type, F.lit("")), F.coalesce(source, F.lit("")))
    return F.coalesce(*[F.when(any_hit(both, ks), label) for label, ks in rules], F.when(t.isin(*known), t), F.lit(default))


def stance(value: Column, good: Iterable[str] = ("利好", "正"), bad: Iterable[str] = ("利空", "负")) -> Column:
    """1, -1 or 0 by words of a sentiment label."""
    v = F.trim(F.coalesce(value, F.lit("")))
    return F.when(any_hit(v, good), 1).when(any_hit(v, bad), -1).otherwise(0)


def query_part(url: Column, key: str) -> Column:
    """A parameter of a url's query, decoded and trimmed; blank without it."""
    raw = F.coalesce(F.regexp_extract(F.coalesce(url, F.lit("")), f"[?&]{key}=([^&#]*)", 1), F.lit(""))
    return F.trim(F.coalesce(F.try_url_decode(raw), F.lit("")))


def derived_files(host: str, item: Column, time: Column) -> Column:
    """The two addresses under which an announcement's file may stand; none without an id or a day."""
    day = F.substring(F.trim(F.coalesce(time, F.lit(""))), 1, 10)
    urls = F.array(*[F.concat(F.lit(f"{host}finalpage/"), day, F.lit("/"), item, F.lit(ext)) for ext in (".PDF", ".pdf")])
    return F.when((F.coalesce(item, F.lit("")) != "") & (F.length(day) == 10), urls).otherwise(F.array().cast("array<string>"))


def state_json(html: Column, variable: str = "window.initialState") -> Column:
    """The JSON object that a page's script assigns to a variable; null where it can't be read."""
    import re

    raw = F.regexp_extract(html, f"(?s){re.escape(variable)}\\s*=\\s*(\\{{.*?\\}})</script>", 1)
    return F.when(F.try_parse_json(F.nullif(raw, F.lit(""))).isNotNull(), raw)
