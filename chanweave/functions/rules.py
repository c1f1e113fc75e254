"""Classification of names by rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import has_chinese, strip

# Keywords by category, in the order in which categories are tried; within one, order does not matter.
RULES = (
    ("cctv", r"\bcctv\b|\bcetv\b|央视|中央\d|中国教育|cctv体育|cctv新闻|cctv\d"),
    ("weishi", r"卫视|卫星|东南台"),
    (
        "gangtai",
        r"香港|台湾|澳门|\btvb\b|凤凰|phoenix|无线|翡翠|星空|华娱|卫视中文|中天|东森|八大|纬来|民视|三立|寰宇|星卫|龙祥|好莱坞|明珠台",
    ),
    ("sports", r"体育|\bespn\b|足球|篮球|\bnba\b|英超|中超|\bcba\b|乒|羽|台球|搏击|咪咕|竞技|赛事|cctv5"),
    ("live", r"斗鱼|虎牙|\bbilibili\b|b站|哔哩|直播|\bdouyu\b|\bhuya\b"),
    ("radio", r"电台|广播|fm\s*\d|am\s*\d|\bradio\b|央广|音乐之声"),
    (
        "overseas",
        r"\bbbc\b|\bcnn\b|\bfox\b|\bnbc\b|\babc\b|\bcbs\b|\bdiscovery\b|nat\.geo|national geographic|\bhbo\b|\bmtv\b|\beuro\b"
        r"|france\d|\baljazeera\b|\bdw\b[\s-]|\brt\b[\s-]|\bnhk\b|\bfuji\b|\btbs\b|tv asahi|tv tokyo",
    ),
    (
        "local",
        r"^(北京|上海|天津|重庆|广东|广州|深圳|浙江|杭州|江苏|南京|山东|济南|青岛|四川|成都|湖北|武汉|湖南|长沙|福建|福州|厦门|河南|郑州"
        r"|河北|石家庄|辽宁|沈阳|吉林|长春|黑龙江|哈尔滨|山西|太原|陕西|西安|甘肃|兰州|青海|西宁|云南|昆明|贵州|贵阳|海南|海口|广西|南宁"
        r"|内蒙古|新疆|西藏|宁夏|江西|南昌|安徽|合肥|大连|宁波|苏州|无锡|佛山|东莞|珠海|中山|惠州|汕头|湛江|温州|绍兴|嘉兴|泉州|漳州|柳州"
        r"|桂林|三亚|澳门|香港|台湾)",
    ),
)
# Hints in the source's own group title, in order.
HINTS = (("cctv", "央视|cctv"), ("weishi", "卫视"), ("sports", "体育"), ("radio", "电台|radio"), ("special", "酒店|special"))


def _column(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def classify_by_rules(name: Column | str, group_title: Column | str) -> Column:
    """Category key: rules on the name, then hints of the group title, then Chinese names are local, others overseas."""
    low, hint = strip(F.lower(_column(name))), F.lower(_column(group_title))
    tests = [(low == "", "other"), *((low.rlike(f"(?U){p}"), k) for k, p in RULES), *((hint.rlike(p), k) for k, p in HINTS)]
    tests.append((has_chinese(_column(name)), "local"))
    return reduce(lambda found, test: found.when(*test), tests[1:], F.when(*tests[0])).otherwise("overseas")


def classify_with_region(name: Column | str, group_title: Column | str, region: Column | str) -> Column:
    """Hotel sources are special; overseas sources keep a rule's answer only for Chinese names."""
    ruled, region = classify_by_rules(name, group_title), F.coalesce(_column(region), F.lit("cn"))
    foreign = F.when(has_chinese(_column(name)), ruled).otherwise("overseas")
    return F.when(region == "hotel", "special").when(region == "overseas", foreign).otherwise(ruled)
