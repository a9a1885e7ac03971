"""Entity master data from announcements and several sources: extraction, folding, overrides, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .upsert import first_wins

# Prefixes of listing codes, industries by words, provinces.
EXCHANGES = {
    "SSE": ("600", "601", "603", "605", "688", "900"),
    "SZSE": ("000", "001", "002", "003", "200", "300", "301", "302"),
    "BSE": ("430", "440", *map(str, range(830, 840)), *map(str, range(870, 880))),
}
SUFFIX = {"SSE": "SH", "SZSE": "SZ", "BSE": "BJ"}
INDUSTRIES = (
    ("军工", ("军工", "航空", "导弹", "无人机", "国防", "战机")),
    ("新能源", ("储能", "电池", "光伏", "电网", "新能源", "输变电")),
    ("科技", ("人工智能", "AI", "算力", "芯片", "机器人", "软件", "数字")),
    ("消费", ("消费", "旅游", "酒店", "饮料", "食品")),
    ("金融", ("银行", "保险", "金融")),
)
OTHER = "其他"
PROVINCES = "北京 上海 天津 重庆 广东 江苏 浙江 山东 河南 四川 湖北 湖南 安徽 福建 河北 陕西 山西 辽宁 吉林 黑龙江 江西 广西 云南 贵州 海南 甘肃 青海 宁夏 新疆 西藏 内蒙古".split()
TYPES = {"SSE": "沪市A股", "SZSE": "深市A股", "BSE": "北交所"}
TAG_WORDS = (("银行", "name"), ("保险", "name"), ("芯片", "industry_l2"), ("电池", "industry_l2"))


def exchange(code: Column) -> Column:
    """Exchange of a code by its first three digits; blank for others."""
    return F.coalesce(*[F.when(F.substring(code, 1, 3).isin(*p), k) for k, p in EXCHANGES.items()], F.lit(""))


def suffix(code: Column) -> Column:
    """Market suffix of a code; blank for others."""
    e = exchange(code)
    return F.coalesce(*[F.when(e == k, v) for k, v in SUFFIX.items()], F.lit(""))


def listing(code: Column, strict: bool = False) -> Column:
    """Code with suffix; without an exchange the code itself, or blank if ``strict``."""
    return F.when(suffix(code) != "", F.concat(code, F.lit("."), suffix(code))).otherwise("" if strict else code)


def exchange_of_listing(listing_code: Column) -> Column:
    """Exchange of a listing code by its suffix."""
    return F.coalesce(*[F.when(listing_code.endswith(f".{s}"), k) for k, s in SUFFIX.items()], F.lit(""))


def symbol_listing(value: Column) -> Column:
    """Listing code of a symbol: a known suffix stays, six digits get one by the first digit, else blank."""
    t = F.upper(F.trim(F.coalesce(value, F.lit(""))))
    by_digit = F.when(t.rlike("^[569][0-9]{5}$"), "SH").when(t.rlike("^[023][0-9]{5}$"), "SZ").when(t.rlike("^[48][0-9]{5}$"), "BJ")
    return F.when(t.rlike("^[^.]*\\.(SZ|SH|BJ)$"), t).otherwise(F.coalesce(F.concat(t, F.lit("."), by_digit), F.lit("")))


def bare_name(value: Column) -> Column:
    """A name without white space."""
    return F.regexp_replace(F.coalesce(value, F.lit("")), T.SPACE, "")


def industry(text: Column, rules=INDUSTRIES, default: str = OTHER) -> Column:
    """The first industry with a word in the text."""
    clean = F.regexp_replace(F.coalesce(text, F.lit("")), "证券代码|证券简称", "")
    return T.first_label(clean, rules, default)


def ordered_tags(*items: Column) -> Column:
    """Distinct items in order, without blanks and the word nan."""
    clean = F.transform(F.array(*items), lambda x: F.trim(F.coalesce(x, F.lit(""))))
    return F.array_distinct(F.filter(clean, lambda x: (x != "") & (F.lower(x) != "nan")))


def concept_tags(industry_l1: Column, industry_l2: Column, name: Column) -> Column:
    """Both industries, and words that the name or the finer industry holds."""
    of = {"name": F.coalesce(name, F.lit("")), "industry_l2": F.coalesce(industry_l2, F.lit(""))}
    return ordered_tags(industry_l1, industry_l2, *[F.when(F.contains(of[k], F.lit(w)), w) for w, k in TAG_WORDS])


def region(area: Column, province: Column, city: Column, area_first: bool = False) -> Column:
    """Province and city joined, or what there is of them, or the area; the area first if asked."""
    a, p, c = (F.nullif(F.trim(F.coalesce(x, F.lit(""))), F.lit("")) for x in (area, province, city))
    both = F.when(p.isNotNull() & c.isNotNull() & (p != c), F.concat_ws("-", p, c))
    return F.coalesce(*([a, both, p, c] if area_first else [both, p, c, a]))


def region_of_address(address: Column, provinces=PROVINCES) -> Column:
    """Province at an address's start (its first eight characters), with the city after it."""
    text = F.trim(F.coalesce(address, F.lit("")))
    found = F.coalesce(*[F.when(F.contains(F.substring(text, 1, 8), F.lit(p)), p) for p in provinces])
    tail = F.substring(text, F.instr(text, found) + F.length(found), F.length(text))
    bare = F.regexp_replace(tail, "^(?:省|市|自治区|壮族自治区|回族自治区|维吾尔自治区)", "")
    city = F.regexp_extract(bare, "([\\u4e00-\\u9fa5]{2,8})市", 1)
    return F.when(found.isNull(), "").when((city != "") & (city != found), F.concat_ws("-", found, city)).otherwise(found)


def company_type(exchange_name: Column, *given: Column) -> Column:
    """The first given type that isn't blank, else by exchange."""
    filled = [F.nullif(F.trim(F.coalesce(g, F.lit(""))), F.lit("")) for g in given]
    return F.coalesce(*filled, *[F.when(exchange_name == k, v) for k, v in TYPES.items()], F.lit("A股"))


def extracted(docs: DataFrame, code: str = "^[0-9]{6}$", in_content: str = "证券代码[:：]?\\s*([0-9]{6})", short: str = "证券简称[:：]\\s*([^\\s；;，,]+)", short_title: str = "^([^：:]{2,12})[：:]", full_title: str = "^(.+?(?:股份)?有限公司)", full_mark: str = "股份有限公司", rules=INDUSTRIES, default: str = OTHER) -> DataFrame:
    """(code, short_name, full_name, industry, and the document's columns) of documents that name a company by its code."""
    title, content = F.trim(F.coalesce("title", F.lit(""))), F.trim(F.coalesce("content", F.lit("")))
    symbol = F.trim(F.coalesce("symbol_or_subject", F.lit("")))
    found = F.when(symbol.rlike(code), symbol).otherwise(F.regexp_extract(content, in_content, 1))
    first = F.substring_index(content, "；", 1)
    names = {
        "code": found,
        "short_name": bare_name(F.coalesce(F.nullif(F.regexp_extract(content, short, 1), F.lit("")), F.regexp_extract(title, short_title, 1))),
        "full_name": F.trim(F.coalesce(F.nullif(F.regexp_extract(title, full_title, 1), F.lit("")), F.when(F.contains(first, F.lit(full_mark)), first), F.lit(""))),
        "industry": industry(F.concat_ws(" ", "source", "title", "content"), rules, default),
    }
    return docs.withColumns(names).filter(F.col("code").rlike(code))


def folded(records: DataFrame, key: str, order: str, plain: list[str], ranked: list[str], tags: str, other: str = OTHER) -> DataFrame:
    """One row a key: the first filled value of ``plain`` columns, the first that isn't blank or other of ``ranked`` ones, all tags in order.

    A ranked column that only has other keeps the last of these, as a fold
    that overwrites it would.
    """
    filled = lambda c: F.when(F.trim(c) != "", F.col(c))
    at = lambda v: F.when(v.isNotNull(), F.col(order))
    out = [F.coalesce(F.min_by(filled(c), at(filled(c))), F.lit("")).alias(c) for c in plain]
    for c in ranked:
        real = F.when((F.trim(c) != "") & (F.trim(c) != other), F.col(c))
        out.append(F.coalesce(F.min_by(real, at(real)), F.max_by(filled(c), at(filled(c))), F.lit("")).alias(c))
    every = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(tags).alias("t")))), lambda x: x["t"]))
    return records.groupBy(key).agg(*out, F.array_distinct(F.filter(every, lambda x: x != "")).alias(tags))


def overridden(rows: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """``rows`` with every filled value of ``overrides`` in place; keys that are only there are added."""
    o = overrides.filter(F.trim(F.coalesce(key, F.lit(""))) != "")
    columns = [c for c in rows.columns if c != key]
    joined = rows.alias("a").join(o.alias("b"), key, "full")

    def one(c):
        if c not in o.columns:
            return F.col(f"a.{c}").alias(c)
        kind = rows.schema[c].dataType.typeName()
        filled = F.when(F.size(f"b.{c}") > 0, F.col(f"b.{c}")) if kind == "array" else F.when(F.trim(f"b.{c}") != "", F.col(f"b.{c}"))
        return F.coalesce(filled, F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c)

    return joined.select(key, *[one(c) for c in columns])


def first_filled_of(base: DataFrame, key: str, sources: dict[str, DataFrame], fields: dict[str, list[str]]) -> DataFrame:
    """``base``'s keys with each field from the first place that has it: ``fields`` name to ["source.column", ...], base itself as "base"."""
    joined = base.alias("base")
    for name, df in sources.items():
        joined = joined.join(first_wins(df, [key], key).withColumnRenamed(key, f"_{name}").alias(name), F.col(f"base.{key}") == F.col(f"_{name}"), "left")
    pick = lambda places: F.coalesce(*[F.nullif(F.trim(F.col(p).cast("string")), F.lit("")) for p in places], F.lit(""))
    return joined.select(F.col(f"base.{key}"), *[pick(places).alias(f) for f, places in fields.items()])
