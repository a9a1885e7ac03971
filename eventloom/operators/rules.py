"""Rule packs: keyword lists and label rules as data, with the published pack and loaders.

The lists below are fixed values: results depend on them word by word.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class RulePack:
    """Keyword lists of the decision list, label rules, and scoring constants."""

    non_event: tuple = ()
    weak: tuple = ()
    routine: tuple = ()
    template: tuple = ()
    company_action: tuple = ()
    narrative_title: tuple = ()
    policy_title: tuple = ()
    macro_title: tuple = ()
    listing_title: tuple = ()
    listing_excluded: tuple = ()
    regulator_routine_title: tuple = ()
    regulator_hard: tuple = ()
    generic_hits: tuple = ()
    announcement_sources: tuple = ()
    government_sources: tuple = ()
    regulator_sources: tuple = ()
    regulator_token: str = ""
    subject: dict = field(default_factory=dict)
    industry: dict = field(default_factory=dict)
    predictability: dict = field(default_factory=dict)
    duration: dict = field(default_factory=dict)
    subject_default: str = "other"
    industry_default: str = "other"
    predictability_default: str = "planned"
    duration_default: str = "medium"
    positive: tuple = ()
    negative: tuple = ()
    emphasis: tuple = ()
    source_weights: tuple = ()
    shock: tuple = ()
    policy_bonus: tuple = ()
    surprise: str = "sudden"
    intensity_base: dict = field(default_factory=dict)
    sentiments: tuple = ("positive", "negative", "neutral")
    threshold: int = 2
    duplicate_cap: int = 3

    @property
    def event(self) -> list[str]:
        """All subject keywords, sorted."""
        return sorted({w for ks in self.subject.values() for w in ks})


def merged(pack: RulePack, feedback: dict[str, dict[str, list[str]]]) -> RulePack:
    """The pack with more keywords for labels of the four dimensions; words that are there already stay once."""
    out = {}
    for dimension, more in feedback.items():
        rules = {k: list(v) for k, v in getattr(pack, dimension).items()}
        for label, ks in more.items():
            rules[label] = list(dict.fromkeys([*rules.get(label, []), *ks]))
        out[dimension] = rules
    return replace(pack, **out)


def feedback(rows) -> dict[str, dict[str, list[str]]]:
    """Keywords by dimension and label from a table (dimension, label, keyword, enabled); only enabled, filled rows count.

    A rule table is small by nature; it is read to the driver, where rules are literals of expressions.
    """
    out: dict[str, dict[str, list[str]]] = {}
    for r in rows.select("dimension", "label", "keyword", "enabled").distinct().orderBy("dimension", "label", "keyword").collect():
        words = [(r[c] or "").strip() for c in ("dimension", "label", "keyword")]
        if all(words) and str(r["enabled"]).strip().lower() not in ("0", "false", "no", "n", ""):
            out.setdefault(words[0], {}).setdefault(words[1], []).append(words[2])
    return out


def from_json(text: str) -> RulePack:
    """A pack from a JSON object with the fields' names."""
    return RulePack(**{k: tuple(map(lambda x: tuple(x) if isinstance(x, list) else x, v)) if isinstance(v, list) else v for k, v in json.loads(text).items()})


PUBLISHED = RulePack(
    non_event=("明星", "综艺", "娱乐", "广告", "直播带货"),
    weak=("年度报告摘要", "常规信息", "董事会报告", "财务报表"),
    routine=("会议决议", "股东会", "业绩说明会", "法律意见书", "募集资金进行现金管理", "自有资金进行现金管理", "进展公告", "提示性公告", "解除质押", "质押", "持股比例", "减持股份", "过户登记", "辞职", "本息兑付", "工商变更登记", "换发安全生产许可证", "临时股东会", "持股计划"),
    template=("公告类型：", "_LC_BULLETIN", "_M_BULLETIN", "_S_BULLETIN", "K_LC_BULLETIN", "M_LC_BULLETIN", "SZZB", "SZCY"),
    company_action=("补缴税款", "增资", "关联交易", "诉讼事项", "诉讼事项进展", "重大仲裁", "仲裁", "重整计划", "重整程序", "法院裁定", "复牌", "停牌", "重大资产置换", "发行股份购买资产", "募集配套资金", "标的资产过户", "资产过户", "担保进展", "委托理财", "终止协议转让", "资源整合", "拟转让", "股权投资意向协议", "股份冻结", "财务资助", "权益分派", "利润分配", "中标", "重大合同", "签署合同", "项目投产", "产能", "业绩预告", "业绩快报", "行政监管措施", "处罚", "风险警示", "ST", "回购注销", "减持计划", "增持计划", "股份转让"),
    narrative_title=("学习贯彻", "述评", "调研时强调", "激励广大干部群众", "春光正好", "新活力", "开创新局面", "真抓实干", "锐意进取", "观察", "综述"),
    policy_title=("印发", "发布", "出台", "通知", "意见", "方案", "措施", "规划", "办法", "指导意见", "实施方案"),
    macro_title=("同比", "环比", "增加值", "CPI", "PPI", "GDP", "PMI", "出口", "进口", "社融", "工业企业利润"),
    listing_title=("聆讯后资料集", "发行聆讯", "H股发行", "上市申请", "递交H股发行上市申请", "刊发申请资料", "上市保荐书", "发行保荐书", "募集说明书"),
    listing_excluded=("提示性公告", "进展公告", "转股情况公告", "法律意见书", "补充法律意见书"),
    regulator_routine_title=("答记者问", "召开", "会议", "接受监察调查", "开除党籍", "违纪违法", "顾问委员会", "新闻发言人"),
    regulator_hard=("公开征求意见", "同意开展", "试点", "办法", "制度", "实施规定", "国务院令", "行政执法", "处罚", "立案"),
    generic_hits=("公告",),
    announcement_sources=("上交所", "深交所", "巨潮资讯网"),
    government_sources=("中国政府网",),
    regulator_sources=("中国证监会",),
    regulator_token="证监会",
    subject={
        "地缘类": ["空战", "冲突", "地缘", "印巴", "克什米尔", "战机", "局势升级", "伊朗", "中东", "霍尔木兹", "战事", "停火"],
        "政策类": ["政策", "发改委", "国务院", "证监会", "支持", "措施", "规划"],
        "公司类": ["公告", "合同", "并购", "重组", "回购", "定增", "业绩预告", "上市申请", "递表", "IPO", "港交所"],
        "行业类": ["行业", "产业链", "景气", "协会", "供需", "价格上涨", "技术突破", "样机"],
        "宏观类": ["降息", "降准", "CPI", "PPI", "GDP", "出口", "财政"],
    },
    industry={
        "军工": ["军工", "战机", "导弹", "无人机", "军品", "空战", "国防", "航空", "航天", "舰船", "兵装", "雷达", "坦克", "军贸", "军演", "装备", "高超音速", "军工股", "军工板块", "歼", "武装", "军控"],
        "新能源": ["新能源", "储能", "锂电", "光伏", "风电", "电池", "充电桩", "新能源汽车", "锂矿", "碳酸锂", "硅料", "组件", "逆变器", "电网", "输变电", "核电", "氢能", "电车", "电动", "光伏产业链", "碳中和", "碳达峰", "绿电", "清洁能源", "分布式", "光伏设备", "风电设备"],
        "科技": ["科技", "机器人", "芯片", "算力", "AI", "人工智能", "人形机器人", "样机", "半导体", "集成电路", "光刻", "5G", "通信", "物联网", "云计算", "大数据", "软件", "数字化", "智能化", "数字人民币", "大模型", "GPT", "量子", "操作系统", "自动驾驶", "智能驾驶", "工业互联网", "信创", "数据要素", "低空经济"],
        "消费": ["消费", "白酒", "旅游", "零售", "餐饮", "食品", "饮料", "家电", "服装", "医美", "化妆品", "医药", "中药", "生物制品", "免税", "酒店", "航空出行", "电影", "游戏", "啤酒", "乳品", "创新药", "制药", "药房", "药企", "制药业", "药监", "临床", "新药", "房产", "房地产", "地产", "物业", "银行业", "证券", "保险", "银行", "金融", "信贷"],
    },
    predictability={"突发型": ["空战", "爆发", "冲突", "突发", "事故", "击落", "伊朗", "中东", "霍尔木兹", "战事"], "预披露型": ["公告", "预告", "政策", "规划", "发布", "签订"]},
    duration={"脉冲型": ["空战", "冲突", "突发", "击落", "热点", "伊朗", "中东", "霍尔木兹", "停火", "战事"], "中期型": ["政策", "合同", "示范项目", "订单", "扩产", "发布", "样机"], "长尾型": ["规划", "技术突破", "产业趋势", "长期"]},
    subject_default="行业类",
    industry_default="其他",
    predictability_default="预披露型",
    duration_default="中期型",
    positive=("利好", "支持", "积极", "增长", "提升", "带动", "受益", "突破", "签订"),
    negative=("利空", "下滑", "亏损", "处罚", "暴跌", "风险", "停牌", "冲突升级"),
    emphasis=("重大", "爆发", "发布", "签订", "支持", "击落", "突破"),
    source_weights=(("中国政府网", 1.0), ("证监会", 1.0), ("国家发改委", 0.95), ("巨潮资讯网", 0.95), ("上交所", 0.9), ("深交所", 0.9), ("财新网", 0.9), ("第一财经", 0.85), ("36氪", 0.75), ("东方财富", 0.7)),
    shock=("重大", "击落", "爆发"),
    policy_bonus=("示范项目", "若干措施"),
    surprise="突发型",
    intensity_base={"地缘类": 82, "政策类": 72, "公司类": 68, "行业类": 64, "宏观类": 75},
    sentiments=("利好", "利空", "中性"),
)

# Words of a text that decide its subject and its industry over what a model has said.
SUBJECT_ANCHORS = (("地缘类", ("中东", "霍尔木兹", "战事", "停火", "冲突", "空战", "印巴", "克什米尔")),)
INDUSTRY_ANCHORS = (
    ("军工", ("军工", "战机", "导弹", "无人机", "国防", "军品", "装备", "高超音速", "舰船", "雷达")),
    ("新能源", ("新能源", "储能", "光伏", "锂电", "电池", "风电", "充电桩", "逆变器", "碳中和", "绿电")),
    ("消费", ("轻工业", "零售", "餐饮", "文旅", "旅游", "消费", "医药", "药", "房产", "地产", "银行", "金融", "白酒", "食品")),
    ("科技", ("无线电", "卫星", "通信", "物联网", "人工智能", "具身智能", "半导体", "芯片", "算力", "5G", "信创", "低空经济", "数字人民币")),
)

#: A pack for the given tables, of words that occur in them.
NEUTRAL = RulePack(
    non_event=("scum",),
    weak=("Contact", "@"),
    routine=("License", "licensed"),
    template=("###", "$$$"),
    company_action=("threat", "worthless"),
    narrative_title=("The the", "And the"),
    policy_title=("ing",),
    macro_title=("tion",),
    listing_title=("ble",),
    listing_excluded=("er",),
    regulator_routine_title=("Und", "Der"),
    regulator_hard=("heit",),
    generic_hits=("the",),
    announcement_sources=("src1",),
    government_sources=("src2",),
    regulator_sources=("src3",),
    regulator_token="und",
    subject={"a": ["stupid", "idiot", "pathetic"], "b": ["the", "tion"], "c": ["und", "der", "keit"], "d": ["les", "eaux"], "e": ["ción", "mente"]},
    industry={"x": ["ing", "ness"], "y": ["ment", "eux"], "z": ["ung", "heit"]},
    predictability={"sudden": ["threat", "disgusting"], "planned": ["the", "der", "les"]},
    duration={"pulse": ["disgusting"], "medium": ["ou", "en"], "long": ["heit", "aux"]},
    positive=("with", "pour", "para", "auf"),
    negative=("not", "pas", "nicht", "stupid"),
    emphasis=("The", "La", "Die"),
    source_weights=(("src1", 0.95), ("src2", 0.85)),
    shock=("disgusting",),
    policy_bonus=("License",),
    intensity_base={"a": 82, "b": 64, "c": 72},
)
