"""Structured events: every column of a classified document as an expression, and candidate rows with evidence."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.keywords import Scan
from . import detect, entities
from .rules import RulePack

VERSION = "task1_rules_v1"


@dataclass(frozen=True)
class LabelRules:
    """Rules of the columns beside those of the rule pack: (label, keywords) in order, the first that hits decides."""

    source_type: tuple = ()
    authority: tuple = ()
    subtype: tuple = ()
    subtype_of: dict = field(default_factory=dict)
    time: tuple = ()
    stage: tuple = ()
    shock: tuple = ()
    region: tuple = ()
    triggers: tuple = ()
    doubts: tuple = ()
    official: tuple = ("官方文件", "监管/交易所", "公司公告")
    trusted: tuple = ("主流财经媒体", "行业协会/机构")
    wide_subjects: tuple = ("宏观类", "政策类")
    wide_words: tuple = ("全国", "全市场", "行业")
    group_subjects: tuple = ("地缘类", "行业类", "政策类")
    single_subject: str = "公司类"
    scopes: tuple = ("全市场", "行业", "个股链条")
    defaults: tuple = ("其他来源", "general_media", "未细分", "current_confirmed", "确认", "其他", "domestic")
    explicit: tuple = ("\\d+(?:\\.\\d+)?\\s*(?:万亿|亿|万元|亿元|万美元|亿美元)", "\\d+(?:\\.\\d+)?\\s*%", "20\\d{2}年|\\d{1,2}月\\d{1,2}日|截至|到期|期限", "公司|企业|行业|部门|机构")
    #: Units in the pattern's order: factor, and whether amounts below 1000 are in ten thousandths.
    units: tuple = (("万亿", 10000.0, False), ("亿", 1.0, False), ("万元", 1.0, True), ("亿元", 1.0, False), ("万美元", 1.0, True), ("亿美元", 1.0, False))
    name_suffix: str = "相关事件"
    stop: str = "。"
    entity: entities.EntityRules = entities.PUBLISHED


# The labels' keywords, on which results depend word by word.
PUBLISHED = LabelRules(
    source_type=(("官方文件", ("中国政府网", "国务院", "国家发展改革委", "发改委", "工信部", "商务部", "财政部", "央行")), ("监管/交易所", ("中国证监会", "证监会", "上交所", "深交所", "北交所")), ("公司公告", ("巨潮资讯网", "公司公告", "公告")), ("主流财经媒体", ("财新", "第一财经", "东方财富", "36氪", "证券时报", "中国证券报")), ("行业协会/机构", ("协会", "商会", "联盟", "研究院"))),
    authority=(("central", ("中国政府网", "国务院", "新华社", "人民日报", "央视财经")), ("ministry", ("国家发展改革委", "发改委", "工信部", "财政部", "央行", "商务部", "国家统计局", "海关总署")), ("exchange", ("中国证监会", "证监会", "上交所", "深交所", "北交所")), ("listed_company", ("巨潮资讯网", "公司公告", "年度报告", "临时公告")), ("top_media", ("财新", "第一财经", "上海证券报", "证券时报", "中国证券报", "Bloomberg", "Reuters"))),
    subtype=(
        ("产业政策", ("产业政策", "行动计划", "实施方案", "发展方案", "促进", "支持", "补贴")),
        ("监管政策", ("监管", "规范", "审查", "处罚", "问询", "征求意见", "规则")),
        ("财政税收", ("财政", "税", "减免", "退税", "专项债")),
        ("货币金融", ("利率", "降准", "降息", "社融", "信贷", "汇率")),
        ("业绩公告", ("业绩", "营收", "净利润", "利润", "财报", "预告")),
        ("重大合同", ("合同", "订单", "中标", "采购")),
        ("产能投产", ("投产", "扩产", "产能", "开工", "竣工")),
        ("产品发布", ("产品发布", "新品", "发布会", "临床试验批准", "临床试验申请", "上市许可申请", "获受理", "获批")),
        ("股权变动", ("股权", "增持", "减持", "回购", "并购", "重组", "定增", "递表", "IPO", "辅导验收", "发行H股", "赴港IPO", "股份冻结", "股份转让", "风险警示", "退市风险警示", "撤销退市风险警示", "摘帽", "摘星", "戴帽", "ST")),
        ("诉讼仲裁", ("诉讼", "仲裁", "法院裁定", "处罚", "监管措施")),
        ("高管变动", ("聘任", "辞职", "辞任", "财务总监", "董秘", "总裁", "董事长", "高管")),
        ("技术标准", ("技术标准", "行业标准", "标准发布")),
        ("供需价格", ("价格", "涨价", "降价", "库存", "供需", "资金流向", "资金流入", "资金流出", "资金流入榜", "资金流出榜", "两融余额", "融资余额", "杠杆资金", "股息率", "分红", "成交额突破", "成交额", "净流入", "净流出", "排行榜", "新建仓")),
        ("宏观数据", ("GDP", "CPI", "PPI", "PMI", "社融", "失业率", "增加值")),
        ("贸易摩擦", ("贸易摩擦", "关税", "制裁", "出口管制")),
        ("区域冲突", ("冲突", "战事", "空战", "停火", "中东", "霍尔木兹", "印巴")),
        ("自然灾害", ("地震", "洪水", "台风", "灾害")),
        ("公共卫生", ("疫情", "公共卫生", "传染病")),
        ("安全事故", ("事故", "爆炸", "停产", "罢工")),
    ),
    subtype_of={"公司类": "公司事项", "行业类": "行业跟踪", "政策类": "政策动态", "宏观类": "宏观跟踪", "地缘类": "地缘事件"},
    time=(("future_oriented", ("将", "未来", "明年", "后续", "预计", "有望", "计划", "拟")), ("retrospective", ("已", "此前", "过去", "去年", "以来", "回顾", "复盘"))),
    stage=(("预期", ("拟", "计划", "预计", "可能", "或将", "有望", "征求意见")), ("落地/执行", ("发布", "印发", "实施", "落地", "执行", "正式", "启动")), ("反馈", ("同比", "增长", "下降", "运行", "成效", "反馈", "数据"))),
    shock=(("自然灾害", ("地震", "洪水", "台风", "灾害")), ("公共卫生", ("疫情", "公共卫生", "传染病")), ("安全事故", ("事故", "爆炸", "停产", "罢工")), ("地缘政治", ("中东", "霍尔木兹", "战事", "停火", "冲突", "空战", "印巴", "克什米尔")), ("政策制度", ("政策", "监管", "制度", "规则", "方案", "通知", "办法", "标准")), ("技术系统冲击", ("技术突破", "人工智能", "物联网", "通信", "卫星", "网络安全", "系统故障"))),
    region=(("global", ("全球", "国际", "世界", "跨市场", "跨资产")), ("overseas", ("美国", "欧洲", "日韩", "东南亚", "海外", "境外")), ("regional", ("长三角", "珠三角", "京津冀", "区域", "省内", "本地"))),
    triggers=("重大", "首次", "突破", "全面", "紧急", "超预期", "重磅", "落地", "提速", "大幅"),
    doubts=("拟", "计划", "预计", "可能", "或将", "有望", "研究", "探讨", "征求意见"),
)

#: Rules for the given tables.
NEUTRAL = LabelRules(
    source_type=(("official", ("src1",)), ("exchange", ("src2",)), ("press", ("src3", "src4"))),
    authority=(("central", ("src10", "src11")), ("top", ("src3",))),
    subtype=(("licence", ("License", "licensed")), ("insult", ("stupid", "idiot")), ("ending", ("ation", "heit"))),
    subtype_of={"a": "a-event", "b": "b-event", "c": "c-event"},
    time=(("future_oriented", ("will", "wird")), ("retrospective", ("was", "war"))),
    stage=(("expected", ("ing ",)), ("running", ("ment ", "ung "))),
    shock=(("threat", ("threat",)), ("worth", ("worthless",))),
    region=(("global", ("the the",)), ("overseas", ("der der", "de de"))),
    triggers=("The", "Die", "La", "ness"),
    doubts=("not", "nicht", "pas"),
    official=("official", "exchange"),
    trusted=("press",),
    wide_subjects=("b", "c"),
    wide_words=("tion the", "heit der"),
    group_subjects=("a", "b"),
    single_subject="d",
    scopes=("market", "group", "single"),
    defaults=("other", "general", "none", "current", "confirmed", "other", "domestic"),
    explicit=("\\d{3,}", "%", "\\d{2}-\\d{2}", "License|Contact"),
    units=(("-", 10.0, False), ("@", 1.0, True), ("%", 1.0, False)),
    name_suffix=" event",
    stop=". ",
    entity=entities.NEUTRAL,
)


def subtype(full: Column | Scan, r: LabelRules) -> Column:
    """The first subtype with a word in the text, else the one of the subject type, else none."""
    return F.coalesce(*[F.when(T.any_hit(full, ks), label) for label, ks in r.subtype], *[F.when(F.col("subject_type") == k, v) for k, v in r.subtype_of.items()], F.lit(r.defaults[2]))


def impact_scope(subject: Column, industry: Column, full: Column | Scan, r: LabelRules, industry_default: str) -> Column:
    """The coarse scope: the market, a group of entities, or one."""
    market, group, single = r.scopes
    return (
        F.when(subject.isin(*r.wide_subjects) & T.any_hit(full, r.wide_words), market)
        .when(subject.isin(*r.group_subjects), group)
        .when(subject == r.single_subject, single)
        .when(industry != industry_default, group)
        .otherwise(single)
    )


def explicitness(full: Column, own_entities: Column, r: LabelRules) -> Column:
    """0 to 4: an amount, a share, a date, an actor."""
    amount, share, date, actor = r.explicit
    return sum((F.rlike(full, F.lit(p)).cast("int") for p in (amount, share, date)), F.lit(0)) + ((F.size(own_entities) > 0) | F.rlike(full, F.lit(actor))).cast("int")


def largest_amount(full: Column, r: LabelRules) -> Column:
    """The largest amount by its unit's factor; amounts of 1000 and more aren't scaled down."""
    units = "|".join(u for u, _, _ in r.units)
    factor = F.create_map(*[F.lit(x) for u, f, _ in r.units for x in (u, f)])
    small = [u for u, _, s in r.units if s]

    def value(x):
        v = x["n"] * F.element_at(factor, x["u"])
        return F.when((v < 1000) & x["u"].isin(*small), v / 10000).otherwise(v) if small else v

    return F.array_max(F.transform(T.amounts(full, f"(\\d+(?:\\.\\d+)?)\\s*({units})"), value))


def amount_scale(full: Column, r: LabelRules, most: Column | None = None) -> Column:
    """none, small, medium, large or huge by the largest amount, which may be there as ``most``."""
    most = largest_amount(full, r) if most is None else most
    return F.when(most.isNull(), "none").when(most >= 1000, "huge").when(most >= 100, "large").when(most >= 10, "medium").otherwise("small")


def _dimensions(full: Column | Scan, pack: RulePack) -> dict[str, Column]:
    return {k: T.best_rule(full, getattr(pack, k), getattr(pack, f"{k}_default")) for k in ("subject", "industry", "predictability", "duration")}


def _hits(best: Column) -> Column:
    return F.when(F.size(best["hits"]) > 0, F.array_join(best["hits"], ",")).otherwise("none")


def candidates(docs: DataFrame, pack: RulePack) -> DataFrame:
    """Detected documents with the evidence of their decision and of each dimension."""
    found = detect.detected(detect.with_words(detect.with_duplicates(docs), pack), pack)
    parts = [F.concat(F.lit(f"{k}:"), _hits(best)) for k, best in _dimensions(detect.full_words(), pack).items()]
    evidence = F.concat(F.lit("hits="), F.array_join(T.hits(detect.full_words(), pack.event), ","), F.lit(f"; rule_version={VERSION}; dimensions="), F.concat_ws("|", *parts))
    return found.withColumn("evidence", evidence).drop("_words")


def structured(docs: DataFrame, pack: RulePack, rules: LabelRules, symbol: str | None = None, keep: tuple = ()) -> DataFrame:
    """``docs`` (with duplicate_group_size) as structured events with all columns and those of ``docs`` to keep; url is the reference to the text."""
    kept = [*keep, "url", *[c for c in docs.columns if c.endswith("_id")]]
    full, title = F.concat_ws(" ", "title", "content"), F.col("title")
    other_source, general, _, current, confirmed, other_shock, domestic = rules.defaults
    words = detect.full_words()
    d = detect.classified(detect.with_words(docs, pack, rules), pack).withColumns({"_full": full, **{f"_{k}": v for k, v in _dimensions(words, pack).items()}})
    full = F.col("_full")
    d = d.withColumns({"_own": entities.named(full, rules.entity), "_most": largest_amount(full, rules)})  # read more than once
    d = d.withColumn("subject_entities", entities.subject_entities(full, rules.entity, F.col(symbol) if symbol else None, title, F.col("_own")))
    d = d.withColumn("source_type", T.first_label(F.coalesce("source", F.lit("")), rules.source_type, other_source))
    d = d.withColumns(
        {
            "event_name": F.when(F.size("subject_entities") > 0, F.concat(F.col("subject_entities")[0], F.lit(rules.name_suffix))).otherwise(F.substring("title", 1, 24)),
            "event_date": F.to_date("publish_time"),
            "authority_level": T.first_label(F.coalesce("source", F.lit("")), rules.authority, general),
            "source_credibility_score": F.when(F.col("source_type").isin(*rules.official), 3).when(F.col("source_type").isin(*rules.trusted), 2).otherwise(1),
            "event_subject_subtype": subtype(words, rules),
            "time_orientation": T.first_label(words, rules.time, current),
            "event_stage": T.first_label(words, rules.stage, confirmed),
            "shock_source_type": T.first_label(words, rules.shock, other_shock),
            "region_scope": T.first_label(words, rules.region, domestic),
            "trigger_word_score": T.n_hits(words, rules.triggers),
            "explicitness_score": explicitness(full, F.col("_own"), rules),
            "uncertainty_score": T.n_hits(words, rules.doubts),
            "amount_scale": amount_scale(full, rules, F.col("_most")),
            "impact_scope": impact_scope(F.col("subject_type"), F.col("industry_type"), words, rules, pack.industry_default),
            "event_summary": F.concat(title, F.lit(rules.stop), F.regexp_replace(F.substring("content", 1, 70), "[，。；; ]+$", "")),
            "classification_evidence": F.concat_ws("|", F.lit(f"rule_version={VERSION}"), *[F.concat(F.lit(f"{k}="), _hits(F.col(f"_{k}"))) for k in ("subject", "industry", "predictability", "duration")]),
        }
    )
    bare = [F.replace(F.col(c), F.lit("/"), F.lit("")) for c in ("subject_type", "event_subject_subtype", "duration_type", "impact_scope", "shock_source_type")]
    d = d.withColumn("event_code", F.array_join(F.filter(F.array(*bare), lambda x: x != ""), "-"))
    return d.select(
        *kept, "event_id", "event_name", "event_date", "source", "source_type", "authority_level", "source_credibility_score", F.col("subject_type").alias("event_subject_type"), "event_subject_subtype",
        "duration_type", "predictability_type", "industry_type", "sentiment", "time_orientation", "event_stage", "shock_source_type", "region_scope", "trigger_word_score", "explicitness_score",
        "uncertainty_score", "novelty_score", "amount_scale", "event_code", "heat_score", "intensity_score", "impact_scope", "event_summary", "subject_entities", F.col("url").alias("raw_text_ref"), "classification_evidence",
    )
