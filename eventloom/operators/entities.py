"""Names in event texts: subject entities, phrases, tokens, and which names of a table a text holds."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


@dataclass(frozen=True)
class EntityRules:
    """What counts as an entity: a pattern, words that are none, and prefixes of what is none."""

    pattern: str
    tokens: tuple = ()
    prefixes: tuple = ()
    shortest: int = 2
    longest: int = 24


# The pattern of names and the words that are no names.
PUBLISHED = EntityRules(
    pattern="[0-9]{6}\\.(?:SZ|SH|BJ)|[0-9]{6}|[\\u4e00-\\u9fa5A-Za-z0-9\\*]{2,20}(?:股份有限公司|集团股份有限公司|集团有限公司|有限公司|集团|银行|证券|保险|医药|科技|电力|动力|航空|生物|智农|制药|能源)"
    "|印巴|克什米尔|歼\\-?10CE|中航成飞|霍尔木兹|中东",
    tokens=("LC", "ST", "SZCY", "SZZB", "TOP50", "SK", "CP", "CMG", "CCTV", "IPO", "IRGC", "CRU", "CPU", "CPO", "ESG", "AI"),
    prefixes=("关于", "公司", "行业", "本次", "有关", "今日", "今年", "一季度", "二季度", "三季度", "四季度", "年度"),
)
GENERIC_SUFFIXES = ("相关事件", "事件", "公告", "新闻发布会", "发布会")
GENERIC_TOKENS = ("相关事件", "事件", "公告", "发布", "举行", "召开", "财新闻", "新华社", "央视网", "中国政府网", "中国证监会", "证监会", "工信部", "政策文件", "股市快讯", "最新公告", "mini")

#: For the given tables.
NEUTRAL = EntityRules(pattern="[A-Z][a-z]{7,}|[a-z]{4,}(?:tion|heit|ment)|[0-9]{4,}", tokens=("than",), prefixes=("The", "Der", "De"))


def entity(candidate: Column, rules: EntityRules) -> Column:
    """A candidate without white space and outer punctuation; null where it is no entity."""
    return _checked(_bare(candidate), rules)


def _bare(candidate: Column) -> Column:
    return F.btrim(F.regexp_replace(candidate, T.SPACE, ""), F.lit("：:，。；;（）()[]【】"))


def _checked(bare: Column, rules: EntityRules) -> Column:
    prefixed = F.lit(False)
    for p in rules.prefixes:
        prefixed = prefixed | bare.startswith(p)
    none = prefixed | ~F.length(bare).between(rules.shortest, rules.longest)
    return F.when(~(none | bare.isin(*rules.tokens)) if rules.tokens else ~none, bare)


def _of(candidates: Column, rules: EntityRules) -> Column:
    """Distinct entities of an array of candidates; a candidate is cleaned once, not for each check."""
    return F.array_distinct(F.array_compact(F.transform(F.transform(F.array_distinct(candidates), _bare), lambda x: _checked(x, rules))))


def named(text: Column, rules: EntityRules = PUBLISHED) -> Column:
    """Distinct entities that a text names, in order; null for a null text."""
    return _of(F.regexp_extract_all(text, F.lit(rules.pattern), F.lit(0)), rules)


def subject_entities(text: Column, rules: EntityRules = PUBLISHED, symbol: Column | None = None, title: Column | None = None, own: Column | None = None) -> Column:
    """Distinct entities in order: what stands before a colon in the title, the symbol, then the text's, which may be there as ``own``."""
    first = [] if title is None else [F.regexp_extract(title, "^[^：:]*", 0)]
    if symbol is not None:
        first.append(F.coalesce(symbol, F.lit("")))
    found = named(text, rules) if own is None else own
    every = F.array_distinct(F.concat(_of(F.array(*first), rules), found)) if first else found
    return F.coalesce(every, F.array().cast("array<string>"))


def phrase(text: Column, suffixes: tuple = GENERIC_SUFFIXES) -> Column:
    """Text without white space, generic endings (each once, in order) and outer punctuation."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), T.SPACE, "")
    for s in suffixes:
        out = F.when(out.endswith(s), F.substring(out, F.lit(1), F.length(out) - len(s))).otherwise(out)
    return F.regexp_replace(out, "^[｜|:：，,。. ]+|[｜|:：，,。. ]+$", "")


def phrases(json_list: Column, suffixes: tuple = GENERIC_SUFFIXES) -> Column:
    """Distinct phrases of a JSON list in order; none where it can't be read."""
    items = F.coalesce(F.from_json(json_list, "array<string>"), F.array().cast("array<string>"))
    return F.array_distinct(F.filter(F.transform(items, lambda x: phrase(x, suffixes)), lambda x: x != ""))


def tokens(*parts: Column, stop: tuple = GENERIC_TOKENS, suffixes: tuple = GENERIC_SUFFIXES) -> Column:
    """Distinct tokens of two characters or more of several texts: runs of letters, digits, ideographs and hyphens."""
    found = F.concat(*[F.regexp_extract_all(F.coalesce(p, F.lit("")), F.lit("[\\u4e00-\\u9fffA-Za-z0-9\\-]+"), F.lit(0)) for p in parts])
    clean = F.transform(found, lambda x: phrase(x, suffixes))
    return F.array_distinct(F.filter(clean, lambda x: (F.length(x) >= 2) & ~x.isin(*stop) if stop else F.length(x) >= 2))


def held(df: DataFrame, names: DataFrame, column: str = "name", max_chars: int = 16 << 20):
    """A column function: the distinct names of a table that a text contains, in one pass over the text.

    Names are broadcast to an automaton; a table of over ``max_chars``
    characters of names is split into as many passes, so its size is never a limit.
    """
    distinct = names.select(F.col(column).alias("name")).filter("name IS NOT NULL AND name <> ''").distinct()
    chars = distinct.agg(F.coalesce(F.sum(F.length("name")), F.lit(0))).first()[0]
    parts = max(1, -(-chars // max_chars))
    found = []
    for k in range(parts):
        part = [r[0] for r in distinct.filter(F.pmod(F.xxhash64("name"), F.lit(parts)) == k).collect()]
        found.append(_automaton(df, sorted(part)))
    return lambda text: found[0](text) if parts == 1 else F.flatten(F.array(*[f(text) for f in found]))


_automata: dict = {}


def _automaton(df: DataFrame, names: list[str]):
    shared = df.sparkSession.sparkContext.broadcast((hash(tuple(names)), names))

    @F.arrow_udf("array<string>")
    def search(texts: pa.Array) -> pa.Array:
        key, words = shared.value
        if key not in _automata:
            import ahocorasick

            machine = ahocorasick.Automaton()
            for w in words:
                machine.add_word(w, w)
            machine.make_automaton()
            if len(_automata) > 3:  # the last one goes, so that of more parts the first stay for the next batch
                _automata.popitem()
            _automata[key] = machine
        machine = _automata[key]
        out = [sorted({w for _, w in machine.iter(t.as_py())}) if t.is_valid and words else [] for t in texts]
        return pa.array(out, pa.list_(pa.string()))

    return search
