"""Features of structured events: scope, confidence, chain stages, regions, industries by weighted fields.

Keyword lists are parameters; the published ones that results depend on are
fixed values below.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.keywords import Scan, scanner, words_of

# Words of the score and of the scope.
POSITIVE = ("利好", "增长", "突破", "获批", "中标", "签约", "增持", "回购")
NEGATIVE = ("利空", "下滑", "亏损", "处罚", "风险", "停产", "冲突升级")
UNCERTAIN = ("拟", "计划", "预计", "可能", "或将", "有望", "研究", "探讨", "征求意见")
GENERIC_SUBTYPES = ("", "未细分", "公司事项", "行业跟踪", "政策动态", "宏观跟踪", "地缘事件")
STAGES = {
    "上游资源材料": ("上游", "资源", "原料", "矿", "材料", "矿山", "锂矿", "稀土", "铜箔", "硅料"),
    "设备零部件": ("设备", "零部件", "器件", "模组", "组件", "控制器", "逆变器", "传感器"),
    "中游制造": ("制造", "加工", "生产", "装配", "产线", "代工", "封测", "电芯"),
    "下游应用": ("应用", "终端", "消费端", "装机", "车端", "电站", "工业端", "商业化"),
    "渠道服务": ("渠道", "服务", "经销", "零售网络", "销售网络", "代理"),
    "配套保障": ("配套", "保障", "物流", "运维", "仓储", "认证", "测试"),
}
OFFICIAL = ("官方文件", "监管/交易所", "公司公告")
AUTHORITIES = ("central", "ministry", "exchange", "listed_company", "top_media")


def sentiment_score(text: Column, label: Column, labels: tuple[str, str] = ("利好", "利空")) -> Column:
    """0 to 100: a base by label, 5 for each good word, -5 for each bad one."""
    base = F.when(label == labels[0], 62).when(label == labels[1], 38).otherwise(50)
    return F.greatest(F.lit(0), F.least(base + T.n_hits(text, POSITIVE) * 5 - T.n_hits(text, NEGATIVE) * 5, F.lit(100)))


def chain_stages(text: Column) -> Column:
    """Stages of the value chain with a word in the text, in order."""
    return F.array_compact(F.array(*[F.when(T.any_hit(text, ks), label) for label, ks in STAGES.items()]))


def cities(text: Column) -> Column:
    """Distinct names of cities, districts and counties."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit("([\\u4e00-\\u9fa5]{2,8}(?:市|区|县))"), F.lit(1)))


def impact_scope(text: Column, companies: Column, industries: Column, provinces: Column, countries: Column) -> Column:
    """One of eight levels, the widest that holds."""
    return (
        F.when((countries >= 2) | F.contains(text, F.lit("全球")), "全球面")
        .when(F.contains(text, F.lit("全国")), "全国面")
        .when((provinces >= 2) | T.any_hit(text, ("城市群", "区域")), "区域面")
        .when(industries >= 2, "跨行业面")
        .when(industries == 1, "行业面")
        .when(T.any_hit(text, ("产业链", "上下游", "供应链")), "产业链面")
        .when(companies >= 2, "多主体")
        .otherwise("单主体")
    )


def confidence(text: Column, subtype: Column, industry: Column, sentiment: Column, entities: Column, triggers: Column) -> Column:
    """0.05 to 0.99, 4 digits: bonuses for what is specific, less for words of doubt."""
    score = (
        0.35
        + F.when(~F.coalesce(subtype, F.lit("")).isin(*GENERIC_SUBTYPES), 0.15).otherwise(0.0)
        + F.when(F.coalesce(industry, F.lit("")) != "其他", 0.15).otherwise(0.0)
        + F.when(F.coalesce(sentiment, F.lit("")) != "中性", 0.1).otherwise(0.0)
        + F.when(F.size(entities) > 0, 0.1).otherwise(0.0)
        + F.least(F.coalesce(triggers, F.lit(0)) * 0.03, F.lit(0.12))
        - F.least(T.n_hits(text, UNCERTAIN) * 0.02, F.lit(0.12))
    )
    return F.bround(F.greatest(F.lit(0.05), F.least(score, F.lit(0.99))), 4)


def credibility(source_type: Column, authority: Column) -> Column:
    """Original, relayed by an authority, or a single medium."""
    return F.when(source_type.isin(*OFFICIAL), "官方原文").when(authority.isin(*AUTHORITIES), "权威转述").otherwise("单一媒体")


def industry_scores(title: Column, summary: Column, content: Column, evidence: Column, source: Column, rules: dict[str, tuple[str, ...]], hinted: Column | None = None) -> Column:
    """array of struct(industry, score), best first: 3 for a word in the title, 2.5 summary, 2 intro else 1 body, 1.5 evidence and source, 0.8 if hinted."""
    intro = F.substring(content, 1, 240)
    scored = []
    for i, (name, ks) in enumerate(rules.items()):
        body = F.aggregate(T.words(*ks), F.lit(0.0), lambda s, k: s + F.when(F.contains(intro, k), 2.0).when(F.contains(content, k), 1.0).otherwise(0.0))
        score = T.n_hits(title, ks) * 3.0 + T.n_hits(summary, ks) * 2.5 + body + T.n_hits(evidence, ks) * 1.5 + F.when(T.any_hit(source, ks), 1.5).otherwise(0.0)
        if hinted is not None:
            score = F.when((score > 0) & F.array_contains(hinted, name), score + 0.8).otherwise(score)
        scored.append(F.struct((-score).alias("minus"), F.lit(i).alias("i"), F.lit(name).alias("industry")))
    best = F.array_sort(F.filter(F.array(*scored), lambda x: x["minus"] < 0))
    return F.transform(best, lambda x: F.struct(x["industry"].alias("industry"), (-x["minus"]).alias("score")))


def primary_industry(scores: Column, default: str = "其他") -> Column:
    """struct(industry, related): the first, and how many score at least max(2, best - 1.5)."""
    top = F.element_at(scores, 1)
    related = F.size(F.filter(scores, lambda x: x["score"] >= F.greatest(F.lit(2.0), top["score"] - 1.5)))
    return F.when(F.size(scores) > 0, F.struct(top["industry"].alias("industry"), related.alias("related"))).otherwise(F.struct(F.lit(default).alias("industry"), F.lit(0).alias("related")))


def resolved_series(sources: list[tuple[str, DataFrame]], key: str = "entity", day: str = "day", value: str = "daily_return") -> DataFrame:
    """(key, day, value, source): each key's whole series from the first source that has any value for it.

    Sources stand in order of priority.  Only the sources' distinct keys meet;
    series are never mixed.
    """
    tagged = None
    for i, (name, df) in enumerate(sources):
        part = df.filter(F.col(value).isNotNull()).select(key, day, value, F.lit(name).alias("source"), F.lit(i).alias("_priority"))
        tagged = part if tagged is None else tagged.unionByName(part)
    first = tagged.groupBy(key).agg(F.min("_priority").alias("_priority"))
    return tagged.join(first, [key, "_priority"]).drop("_priority")


# Industries with their codes and words, hints of the coarse industry, places, and words of the overrides.
INDUSTRIES = (
    ("801010", "农林牧渔", ("农业", "养殖", "种业", "饲料", "渔业", "生猪", "农产品")),
    ("801020", "采掘", ("采掘", "矿业", "油气", "天然气开采")),
    ("801030", "化工", ("化工", "化纤", "化学", "农药", "化肥", "钛白粉", "氟化工", "基础化工")),
    ("801040", "钢铁", ("钢铁", "特钢", "钢材", "螺纹钢", "不锈钢")),
    ("801050", "有色金属", ("有色", "铜", "铝", "锂", "钴", "镍", "稀土", "黄金", "工业金属")),
    ("801080", "电子", ("半导体", "芯片", "电子", "面板", "元器件", "封测", "消费电子", "显示器件")),
    ("801110", "家用电器", ("家电", "白电", "黑电", "冰箱", "空调", "洗衣机")),
    ("801120", "食品饮料", ("食品", "饮料", "白酒", "乳品", "啤酒", "调味品", "预制菜")),
    ("801130", "纺织服饰", ("纺织", "服饰", "服装", "鞋帽", "家纺")),
    ("801140", "轻工制造", ("轻工", "造纸", "包装", "家居", "文娱用品")),
    ("801150", "医药生物", ("医药", "药", "制药", "生物", "医疗", "创新药", "中药", "器械", "CXO")),
    ("801160", "公用事业", ("电力", "燃气", "水务", "公用事业", "火电", "水电")),
    ("801170", "交通运输", ("航运", "港口", "物流", "铁路", "机场", "快递", "航空运输")),
    ("801180", "房地产", ("地产", "房地产", "物业", "住宅开发", "商业地产", "保障房")),
    ("801200", "商贸零售", ("零售", "商贸", "百货", "电商", "超市", "消费连锁")),
    ("801210", "社会服务", ("旅游", "酒店", "教育", "社会服务", "景区", "免税", "人力服务")),
    ("801230", "综合", ("综合",)),
    ("801710", "建筑材料", ("建材", "水泥", "玻璃", "玻纤", "装修建材")),
    ("801720", "建筑装饰", ("建筑", "装饰", "基建", "工程", "园林", "建筑施工")),
    ("801730", "电力设备", ("电力设备", "光伏", "风电", "储能", "锂电", "逆变器", "输变电", "电池回收")),
    ("801740", "国防军工", ("军工", "国防", "战机", "导弹", "舰船", "雷达", "卫星导航", "低空防务")),
    ("801750", "计算机", ("计算机", "软件", "信创", "云计算", "大数据", "操作系统", "AI软件", "工业软件")),
    ("801760", "传媒", ("传媒", "游戏", "影视", "广告", "出版", "互联网内容")),
    ("801770", "通信", ("通信", "5G", "运营商", "光模块", "光通信", "通信设备")),
    ("801780", "银行", ("银行", "信贷", "存款", "贷款", "商业银行")),
    ("801790", "非银金融", ("证券", "保险", "基金", "非银", "期货", "券商", "资管")),
    ("801880", "汽车", ("汽车", "整车", "零部件", "新能源车", "车企", "汽车电子", "智能驾驶")),
    ("801890", "机械设备", ("机械", "机床", "机器人", "自动化", "工程机械", "仪器设备", "工业母机")),
    ("801950", "煤炭", ("煤炭", "焦煤", "动力煤")),
    ("801960", "石油石化", ("石油石化", "炼化", "石油", "炼油", "化工炼化")),
    ("801970", "环保", ("环保", "污水", "固废", "减排", "节能环保", "环境治理")),
)
HINTS = {"军工": ("国防军工",), "新能源": ("电力设备", "汽车", "有色金属", "公用事业"), "科技": ("电子", "计算机", "通信", "传媒"), "消费": ("食品饮料", "医药生物", "商贸零售", "社会服务", "家用电器", "房地产", "银行", "非银金融")}
PROVINCES = tuple("北京 上海 天津 重庆 广东 江苏 浙江 山东 河南 四川 湖北 湖南 安徽 福建 河北 陕西 山西 辽宁 吉林 黑龙江 江西 广西 云南 贵州 海南 甘肃 青海 宁夏 新疆 西藏 内蒙古".split())
COUNTRIES = tuple("美国 中国 日本 韩国 俄罗斯 乌克兰 伊朗 以色列 印度 巴基斯坦 欧盟 英国 德国 法国 东南亚".split())
GRADUAL = ("持续", "逐步", "加速", "推进", "深化", "优化", "完善")
SHOCKS = (
    ("自然灾害", ("地震", "台风", "洪水", "极端天气", "灾害")),
    ("公共卫生", ("疫情", "传染病", "公共卫生")),
    ("安全事故", ("事故", "爆炸", "停产", "火灾", "安全事件", "召回")),
    ("地缘政治", ("冲突", "战争", "制裁", "中东", "印巴", "伊朗", "关税战", "边境")),
    ("政策制度", ("政策", "通知", "办法", "制度", "监管", "征求意见", "条例", "实施方案")),
    ("金融事件", ("违约", "挤兑", "流动性", "股灾", "金融风险", "暴跌", "融资收紧", "债务")),
    ("供应链冲击", ("断供", "供应链", "航运受阻", "物流受阻", "停航", "缺货", "产能紧张")),
    ("技术革新", ("技术突破", "新技术", "新工艺", "创新", "新产品", "大模型", "临床突破")),
)


@dataclass(frozen=True)
class EnrichRules:
    """Words and labels of the enrichment's columns."""

    industries: tuple = INDUSTRIES
    hints: dict = field(default_factory=lambda: dict(HINTS))
    provinces: tuple = PROVINCES
    countries: tuple = COUNTRIES
    city: str = "[\\u4e00-\\u9fa5]{2,8}(?:市|区|县)"
    stages: dict = field(default_factory=lambda: dict(STAGES))
    gradual: tuple = GRADUAL
    gradual_label: str = "渐进演化型"
    shocks: tuple = SHOCKS
    positive: tuple = POSITIVE
    negative: tuple = NEGATIVE
    labels: tuple = ("利好", "利空", "中性")
    doubts: tuple = ("拟", "计划", "预计", "可能", "或将", "征求意见", "草案", "预案", "研究")
    generic_subtypes: tuple = GENERIC_SUBTYPES
    other: str = "其他"
    scopes: tuple = (("全球",), ("全国",), ("城市群", "区域"), ("产业链", "上下游", "供应链"))
    scope_labels: tuple = ("全球面", "全国面", "区域面", "跨行业面", "行业面", "产业链面", "多主体", "单主体")
    official: tuple = OFFICIAL
    authorities: tuple = AUTHORITIES
    credibility: tuple = ("官方原文", "权威转述", "单一媒体")
    amount: str = T.AMOUNT
    units: dict = field(default_factory=lambda: dict(T.UNITS))


def scored_industries(title: Scan, summary: Scan, intro: Scan, content: Scan, evidence: Scan, source: Scan, coarse: Column, rules: EnrichRules) -> Column:
    """array of struct(score, place, code, industry), best first, ties by the rules' order; those without a word are left out.

    ``intro`` is the beginning of ``content``.
    """
    found = []
    for i, (code, name, ks) in enumerate(rules.industries):
        body = T.n_hits(intro, ks) * 2.0 + F.size(F.array_except(T.hits(content, ks), T.hits(intro, ks))) * 1.0
        score = T.n_hits(title, ks) * 3.0 + T.n_hits(summary, ks) * 2.5 + body + T.n_hits(evidence, ks) * 1.5 + F.when(T.any_hit(source, ks), 1.5).otherwise(0.0)
        hinted = [k for k, names in rules.hints.items() if name in names]
        if hinted:
            score = F.when((score > 0) & coarse.isin(*hinted), score + 0.8).otherwise(score)
        found.append(F.struct((-score).alias("minus"), F.lit(i).alias("place"), F.lit(code).alias("code"), F.lit(name).alias("industry")))
    return F.array_sort(F.filter(F.array(*found), lambda x: x["minus"] < 0))


def matching_industries(text: Column, rules: EnrichRules) -> Column:
    """Names of all industries with a word in the text, in order."""
    return F.array_compact(F.array(*[F.when(T.any_hit(text, ks), name) for _, name, ks in rules.industries]))


def _amount(text: Column, rules: EnrichRules) -> Column:
    rate = F.create_map(*[F.lit(x) for pair in rules.units.items() for x in pair])
    return F.array_max(F.transform(T.amounts(text, rules.amount), lambda x: x["n"] * F.element_at(rate, x["u"])))


def enriched(events: DataFrame, rules: EnrichRules | None = None, backfill: bool = False) -> DataFrame:
    """Structured events with the features of their texts, all as column expressions.

    Input: title, event_name, event_summary, content, classification_evidence,
    source, industry_type, subject_entities (array), sentiment, source_type,
    authority_level, predictability_type, shock_source_type,
    event_subject_subtype, trigger_word_score.  ``backfill`` reads what a later
    pass over stored events reads: no industry, source, subtype or triggers,
    the name as title, and title and body as part of the summary.
    """
    rules = rules or EnrichRules()
    t = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    blank = F.lit("")
    if backfill:
        title, summary, body = t("event_name"), F.trim(F.concat_ws(" ", t("event_summary"), t("title"), t("content"))), blank
        source, coarse, subtype, triggers = blank, blank, blank, F.lit(0)
    else:
        title = F.when(t("title") != "", t("title")).otherwise(t("event_name"))
        summary, body, source, coarse, subtype, triggers = t("event_summary"), t("content"), t("source"), t("industry_type"), t("event_subject_subtype"), F.coalesce("trigger_word_score", F.lit(0))
    proof = t("classification_evidence")
    d = events.withColumns({"_title": title, "_summary": summary, "_body": body, "_text": F.concat_ws(" ", title, summary, body, proof)})
    amounts = F.col("_text")
    texts = [F.col("_title"), F.col("_summary"), F.col("_body"), proof, F.substring("_body", 1, 240), source]
    d = d.withColumn("_found", scanner(words_of(rules), joined=4)(F.array(*texts)))
    parts, text = [Scan(F.col("_found")[i]) for i in (0, 1, 4, 2, 3, 5)], Scan(F.col("_found")[len(texts)])
    d = d.withColumn("_s", scored_industries(*parts, coarse, rules))
    top = F.get(F.col("_s"), F.lit(0))
    related = F.size(F.filter("_s", lambda x: -x["minus"] >= F.greatest(F.lit(2.0), -top["minus"] - 1.5)))
    d = d.withColumns({
        "sw_l1_industry_code": F.coalesce(top["code"], blank), "sw_l1_industry": F.coalesce(top["industry"], F.lit(rules.other)), "industry_count": F.when(F.size("_s") > 0, related).otherwise(0),
        "company_count": F.size("subject_entities"), "province_count": T.n_hits(text, rules.provinces), "country_count": T.n_hits(text, rules.countries), "city_count": F.size(F.array_distinct(F.regexp_extract_all(amounts, F.lit(rules.city), F.lit(0)))),
        "chain_stages": F.array_compact(F.array(*[F.when(T.any_hit(text, ks), k) for k, ks in rules.stages.items()])), "amount_max_rmb": _amount(amounts, rules),
    })
    good, bad, neutral = rules.labels
    base = F.when(t("sentiment") == good, 62).when(t("sentiment") == bad, 38).otherwise(50)
    world, land, area, chain = rules.scopes
    names = rules.scope_labels
    scope = (
        F.when((F.col("country_count") >= 2) | T.any_hit(text, world), names[0]).when(T.any_hit(text, land), names[1]).when((F.col("province_count") >= 2) | T.any_hit(text, area), names[2])
        .when(F.col("industry_count") >= 2, names[3]).when(F.col("industry_count") == 1, names[4]).when(T.any_hit(text, chain), names[5]).when(F.col("company_count") >= 2, names[6]).otherwise(names[7])
    )
    points = (
        F.lit(3500) + F.when(~subtype.isin(*rules.generic_subtypes), 1500).otherwise(0) + F.when(coarse != rules.other, 1500).otherwise(0) + F.when(t("sentiment") != neutral, 1000).otherwise(0)
        + F.when(F.size("subject_entities") > 0, 1000).otherwise(0) + F.least(triggers * 300, F.lit(1200)) - F.least(T.n_hits(text, rules.doubts) * 200, F.lit(1200))
    )
    official, relayed, single = rules.credibility
    d = d.withColumns({
        "sentiment_score_0_100": F.greatest(F.lit(0), F.least(base + T.n_hits(text, rules.positive) * 5 - T.n_hits(text, rules.negative) * 5, F.lit(100))),
        "source_credibility_type": F.when(t("source_type").isin(*rules.official), official).when(t("authority_level").isin(*rules.authorities), relayed).otherwise(single),
        "amount_log_rmb": F.round(F.log10(F.col("amount_max_rmb") + 1), 6), "chain_stage_count": F.size("chain_stages"),
        "predictability_type": F.when(T.any_hit(text, rules.gradual), rules.gradual_label).otherwise(F.coalesce(F.nullif(t("predictability_type"), blank), F.lit("预披露型"))),
        "shock_source_type": T.anchored(text, rules.shocks, F.coalesce(F.nullif(t("shock_source_type"), blank), F.lit(rules.other))),
        "impact_scope": scope, "classification_confidence": F.greatest(F.lit(500), F.least(points, F.lit(9900))) / 10000,
    })
    return d.drop("_title", "_summary", "_body", "_text", "_found", "_s")


def needs_model(threshold: float, other: str = "其他", generic: tuple = GENERIC_SUBTYPES) -> Column:
    """Whether an enriched event is too vague for rules alone."""
    c = F.col
    return (c("sw_l1_industry") == other) | (c("industry_count") == 0) | (c("shock_source_type") == other) | F.coalesce(c("event_subject_subtype"), F.lit("")).isin(*generic) | (c("classification_confidence") < threshold)


def needy(events: DataFrame, threshold: float, first: str, last: str, day: str = "event_date") -> DataFrame:
    """Stored events of a range of days that lack a feature or are less sure than the threshold."""
    lacking = F.col("sw_l1_industry").isNull() | (F.col("sw_l1_industry").isin("", "其他")) | F.col("sentiment_score_0_100").isNull() | (F.coalesce("classification_confidence", F.lit(0.0)) < threshold)
    return events.filter(lacking & F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date")))
