"""Problem 9: find personal information in free text and replace it.

Finding: one scanner per kind (e-mail, phone, citizen number, address, name). Numbers are
checked by form, date and check character; addresses and names by grammars anchored on what
surrounds them (lead-in words, titles, labels, verbs, other names). Every mention belongs to an
entity, its kind and canonical form.

Replacing (method: surrogate generation): every entity gets a keyed surrogate of its kind that
keeps script, format, length, country or sex and, where the titles of its mentions tell it, gender
(settled once over the table of all mentions), and is written inside a typed placeholder such as
``[PHONE:0961-4420158]``. The same entity, however it is written, gets the same surrogate
everywhere (coreference); two entities that would get the same one are told apart by a number
given after a collision check over the table of all distinct entities.

Scale: finding is one pass. For replacing, mentions are cut to distinct entities map-side before
they move; only the entities that have a gender or clash come back, by broadcast under a checked
number (``at_once``) and by a join beyond it, so up to that number no text moves.

Defined results: null and empty text have no mentions and come out unchanged; mentions do not
overlap (the kind named first above wins); repeated documents repeat their mentions.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from sheafline.session import spread, stage

KINDS = ("email", "id_number", "phone", "address", "name")

# -- e-mail ---------------------------------------------------------------------------------
_AT = r"(?:\s?[@＠]\s?|\s?[\[（(【{<]\s?(?:at|AT|At)\s?[\]）)】}>]\s?)"
_DOT = r"(?:\.|\s?[\[（(【{]\s?(?:dot|DOT)\s?[\]）)】}]\s?)"
EMAIL = re.compile(
    rf"(?<![A-Za-z0-9._+\-/])[A-Za-z0-9](?:[A-Za-z0-9._%+\-]*[A-Za-z0-9_])?{_AT}[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?(?:{_DOT}[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?)*{_DOT}[A-Za-z]{{2,24}}(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9._+\-/])[A-Za-z0-9][A-Za-z0-9._%+\-]* (?:at|AT) [A-Za-z0-9\-]+(?: (?:dot|DOT) [A-Za-z0-9\-]+)+(?![A-Za-z0-9])"
)
#: Endings that make ``a@2x.png`` a file and no address.
FILES = frozenset("png jpg jpeg gif svg webp bmp pdf tif tiff tex md txt doc docx zip json html css js".split())

# -- numbers ---------------------------------------------------------------------------------
_D = "[0-9０-９]"
ID = re.compile(rf"(?<![0-9０-９A-Za-z.]){_D}{{6}}[ 　]?{_D}{{8}}[ 　]?{_D}{{3}}[0-9０-９XxＸｘ](?![0-9０-９A-Za-z])")
_S = r"[ \-－—‐‑]"
PHONE = re.compile(
    rf"(?<![0-9０-９A-Za-z.+＋])(?:"
    rf"(?:(?:[+＋]|00|００)[8８][6６]{_S}?|[（(][+＋]?[8８][6６][）)]{_S}?)?[1１][3-9３-９]{_D}(?:{_S}?{_D}{{4}}){{2}}"
    rf"|(?:[+＋][8８][6６]{_S}?)?[（(][0０]{_D}{{2,3}}[）)]{_S}?{_D}{{3,4}}{_S}?{_D}{{4}}"
    rf"|(?:[+＋][8８][6６]{_S}?)?[0０]{_D}{{2,3}}{_S}{_D}{{3,4}}{_S}?{_D}{{4}}(?:{_S}{_D}{{1,5}})?"
    rf"|[+＋][8８][6６]{_S}?[1-9]{_D}{{1,2}}{_S}{_D}{{7,8}}"
    rf"|(?:[+＋][1１]{_S}?)?[（(]{_D}{{3}}[）)]{_S}?{_D}{{3}}{_S}{_D}{{4}}"
    rf"|(?:[+＋]?[1１]{_S})?{_D}{{3}}{_S}{_D}{{3}}{_S}{_D}{{4}}"
    rf"|(?:[+＋]?[1１]\.)?{_D}{{3}}\.{_D}{{3}}\.{_D}{{4}}"
    rf"|[+＋](?![8８][6６]|[1１]){_D}{{1,3}}{_S}{_D}{{2,4}}(?:{_S}{_D}{{2,5}}){{1,4}}"
    rf")(?![0-9０-９A-Za-z]|[.．][0-9])"
)
#: What stands before numbers that are no phone.
NOT_PHONE = re.compile(r"(?:条码|条形码|流水号|编号|序列号|订单|单号|批号|批次|job|serial|barcode|batch|No\.|ISBN)[号:： ]*$", re.I)

# -- addresses -------------------------------------------------------------------------------
_H = r"[㐀-鿿]"
STREET = r"(?:路|街|大街|大道|巷|弄|胡同|道|里|条|坊)"
_TAIL = rf"(?:[之\-－]{_D}+)?号(?:院|大院)?(?:[ ，,]?(?:{_D}+|[A-Za-z甲乙丙丁东南西北])(?:号楼|号院|栋|幢|座|单元|楼|层|室|户|弄|号)(?:{_D}+室)?)*"
ADDRESS = re.compile(rf"({_H}{{2,28}}{STREET})({_D}+{_TAIL})")
CHAIN = re.compile(rf"(?:{_H}{{2,3}}省)?(?:{_H}{{2,3}}(?:市|州|盟))?(?:{_H}{{2,3}}(?:市|县|区|旗))*(?:{_H}{{2,3}}(?:镇|乡|街道))?(?:{_H}{{2,3}}(?:村|社区|新村))?{_H}{{1,4}}{STREET}$")
#: Words after which an address begins.
LEAD_WORDS = re.compile(r"^.*(?:寄往|寄到|寄至|寄给|送往|送到|送至|设在|设于|位于|地处|家住|住在|现住|居住于|居住在|搬到|搬至|迁至|迁往|地址是|地址为|前往|去往|来自|在于|就在)")
#: Last characters of the words that lead up to an address.
LEAD = frozenset("往在到至住于从是为址给去来经达由离近")
STREET_EN = re.compile(
    r"(?<![\w.])\d{1,5}[A-Za-z]? (?:(?:North|South|East|West|N\.|S\.|E\.|W\.) )?[A-Z][A-Za-z'\-]+(?: [A-Z][A-Za-z'\-]+){0,2}? (?:Street|Avenue|Lane|Road|Drive|Court|Boulevard|Way|Place|Square|Terrace|Crescent|Close|St|Ave|Rd|Ln|Dr|Blvd)\b\.?"
    r"(?:,? (?:Unit|Apt|Apartment|Suite|Room|Flat|Floor|#)\.? ?#?\w+)?"
)

# -- names -----------------------------------------------------------------------------------
#: Common family names, compound ones first.
FAMILY = (
    "欧阳 司徒 上官 诸葛 司马 夏侯 皇甫 尉迟 公孙 慕容 令狐 端木 东方 南宫 独孤 宇文 长孙 闻人 轩辕 "
    "王 李 张 刘 陈 杨 黄 赵 吴 周 徐 孙 马 朱 胡 郭 何 高 林 罗 郑 梁 谢 宋 唐 许 韩 冯 邓 曹 彭 曾 肖 田 董 袁 潘 于 蒋 蔡 余 杜 叶 程 苏 魏 吕 丁 任 沈 姚 卢 姜 崔 钟 谭 陆 汪 范 金 石 廖 贾 夏 韦 付 方 白 邹 孟 熊 秦 邱 江 尹 薛 闫 段 雷 侯 龙 史 陶 黎 贺 顾 毛 郝 龚 邵 万 钱 严 覃 武 戴 莫 孔 向 汤 祁 褚 柯 阮 裴 卓 蓝 章 鲁 葛 苗 俞 柳 岑 倪 殷 康 施 牛 洪 翟 安 颜 庄 季 聂 辛 管 祝 左 涂 穆 霍 温 阎 简 饶 欧 车 甘 项 曲 宁 佟 艾 解 路 单 邢 包 齐 傅 虞 乔 骆 宫 关 房 费 佘 凌 盛 "
).split()
_ZH = rf"(?:(?:{'|'.join(x for x in FAMILY if len(x) > 1)})|[{''.join(x for x in FAMILY if len(x) == 1)}])"
_BEFORE = r"(?:联系人|负责人|经办人|审核人|录入人|校对人|收件人|寄件人|监护人|作者|姓名|签名|署名|教师|老师|考生|命题人|审题人|主编|编者)(?:[：:]\s?|为|是)|录入员|监考员|审核员|校对员|管理员|命题组的?|教研组的?|(?:本题|本卷|此题|该题|试卷|由)由?|感谢|致谢|鸣谢|转告"
_AFTER = r"同学|老师|先生|女士|小姐|教授|主任|校长|博士|医生|工程师|于[当本次昨今\d]|提出|指出|核对|校对|审[核题定]|录入|命[题制]|负责|完成|编写|撰写|提供|反馈|签[名字]"
NAME = re.compile(rf"(?:{_BEFORE})({_ZH}{_H}{{1,2}}?)(?={_AFTER}|[，。；、,.;\s）)！!？?<]|$)|(?<!{_H})({_ZH}{_H}{{1,2}}?)(?=(?:同学|老师|先生|女士|小姐|教授|主任|校长|博士)(?!们))")
#: Role names and words that are no person.
ROLES = re.compile(r"^(?:方式|小[明红华刚强丽芳李王张]|某|甲|乙|丙|丁|全体|各位|任课|班主|同学|考生|于是|于当|何时|任何|方向|方法|高中|高考|金属|马上|江河|石头|田径|单摆|向[上下左右]|包括|解[析答题]|路程|安培|温度|单位|关于|龙门|史料|武器|管理|严格|万一|费用|齐全)")
_W = r"[A-Z][a-z]+(?:['’\-][A-Z][a-z]+)?"
_EN = rf"(?:{_W},\s{_W}(?:\s[A-Z]\.)*|{_W},\s[A-Z]\.(?:\s?[A-Z]\.)*|{_W}(?:\s[A-Z]\.)*\s{_W}(?:\s{_W})?|(?:[A-Z]\.\s?)+{_W})"
NAME_EN = re.compile(
    rf"(?:\b(?:[Rr]eviewed|[Cc]hecked|[Tt]yped|[Ww]ritten|[Pp]repared|[Ss]igned|[Ee]dited|[Cc]ompiled|[Aa]pproved|[Ss]ubmitted|[Gg]raded|[Mm]arked|[Ss]canned|[Ss]et|[Ii]nvigilated)\sby\s|\b[Tt]hanks\s(?:go\s)?to\s|\b(?:Author|Contact|Editor|Teacher|Name|Proctor|Invigilator|Examiner|Reviewer|Signed|Attn|From|To):\s?|\bDear\s)(?:(?:Mr|Mrs|Ms|Miss|Dr|Prof|Professor)\.?\s)?({_EN})"
    rf"|\b(?:Mr|Mrs|Ms|Miss|Dr|Prof)\.?\s({_EN})"
    rf"|(?<![A-Za-z.,])(?<!\d )({_EN})(?=\s(?:typed|wrote|reviewed|checked|signed|prepared|marked|graded|edited|scanned|submitted|reported|set|invigilated)\s)"
)
#: Common given names; with a capitalised word behind them they need no other sign.
FIRST = "James John Robert Michael William David Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony Mark Donald Steven Paul Andrew Joshua Kenneth Kevin Brian George Edward Ronald Timothy Jason Jeffrey Ryan Jacob Gary Nicholas Eric Jonathan Stephen Larry Justin Scott Brandon Benjamin Samuel Frank Gregory Raymond Alexander Patrick Jack Dennis Jerry Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Lisa Margaret Betty Sandra Ashley Dorothy Kimberly Emily Donna Michelle Carol Amanda Melissa Deborah Stephanie Rebecca Laura Sharon Cynthia Kathleen Amy Angela Shirley Anna Brenda Pamela Emma Nicole Helen Samantha Katherine Christine Debra Rachel Carolyn Janet Catherine Maria Heather Diane Ruth Julie Olivia Joyce Virginia Victoria Kelly Lauren Christina Joan Evelyn Judith Alice Grace Henry Peter Oliver Lucy Sophie".split()
NAME_FIRST = re.compile(rf"\b(?:{'|'.join(FIRST)})(?: [A-Z]\.)* (?!(?:{'|'.join('The A An At In On By From With Over And Or Is Was Has Road Street Avenue Lane Drive Court Way Place Square School College University Bridge Law'.split())})\b){_W}\b")
#: Signs common in given names, and what may stand around a name in running text.
GIVEN = {
    "m": "伟强磊军勇杰涛斌鹏辉刚健浩宇轩博峰龙飞超毅俊锋栋梁晨志国建松海波亮旭东升振庆元凯诚",
    "f": "芳娜敏静丽娟艳霞婷雪莉萍颖倩蕾琳秀英玲燕慧琴洁梅兰凤欣怡佳琪雯瑶悦莹菲薇月竹春香珍",
    "": "文华明安宁远思清子嘉若一书和平川云心如可晓雨星言希乐天润泽之恒景行知秋木南北真",
}
_PERSON = rf"{_ZH}[{''.join(GIVEN.values())}小大玉桂福]{{2}}"
NAME_RUNNING = re.compile(rf"(?<!{_H})({_PERSON})(?=[和与、及去在来说把将对给向到也是已曾又便就])|(?<=[和与、及])({_PERSON})(?=[去在来说把将对给向到一也是已曾共])")
STARTS = frozenset("The A An At In On By From With Over Near After Between Hence Energy How Find State Compare Explain Sensor Gauge Phone Call Leave Please Pages Scans Room Print Identity Holder Address Post Unit This That Each".split())


def check_character(body: str) -> str:
    """The check character of the first 17 digits of a citizen number."""
    return "10X98765432"[sum(int(c) * w for c, w in zip(body, (7, 9, 10, 5, 8, 4, 2, 1, 6, 3, 7, 9, 10, 5, 8, 4, 2))) % 11]


def check_id(value: str) -> bool:
    """A citizen number: a real date and the right check character."""
    s = unicodedata.normalize("NFKC", value).replace(" ", "").upper()
    try:
        born = datetime.date(int(s[6:10]), int(s[10:12]), int(s[12:14]))
    except ValueError:
        return False
    return 1850 < born.year <= 2100 and check_character(s[:17]) == s[17]


def _address(m: re.Match, text: str) -> tuple[int, int] | None:
    run = m[1]
    if (w := LEAD_WORDS.match(run)) and CHAIN.match(run[w.end() :]):
        return m.start() + w.end(), m.end()
    for i in range(len(run) - 1):
        lead = run[i - 1] in LEAD if i else not re.match(_H, text[m.start() - 1 : m.start()] or "x")
        if lead and CHAIN.match(run[i:]):
            return m.start() + i, m.end()
    for i in range(len(run) - 1):  # no lead-in: the longest chain of places, else the street alone
        if CHAIN.match(run[i:]) and re.match(rf"{_H}{{2,3}}[省市县区镇乡]", run[i:]):
            return m.start() + i, m.end()
    return None


def mentions(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every mention, in order and without overlaps."""
    found: list[tuple[int, int, str]] = []
    taken = bytearray(len(text))

    def add(a: int, b: int, kind: str) -> None:
        if a < b and not any(taken[a:b]):
            taken[a:b] = b"\1" * (b - a)
            found.append((a, b, kind))

    if "@" in text or "＠" in text or " at " in text or re.search(r"[\[（(【{<]\s?[aA][tT]", text):
        for m in EMAIL.finditer(text):
            if m[0].rpartition(".")[2].lower() not in FILES:
                add(m.start(), m.end(), "email")
    for m in ID.finditer(text):
        if check_id(m[0]):
            add(m.start(), m.end(), "id_number")
    for m in PHONE.finditer(text):
        if not NOT_PHONE.search(text, max(0, m.start() - 12), m.start()):
            add(m.start(), m.end(), "phone")
    if "号" in text:
        for m in ADDRESS.finditer(text):
            if span := _address(m, text):
                add(*span, "address")
    for m in STREET_EN.finditer(text):
        end = m.end() - (m[0].endswith(".") and not re.search(r"\b(?:St|Ave|Rd|Ln|Dr|Blvd)\.$", m[0]))
        add(m.start(), end, "address")
    for m in NAME.finditer(text):
        g = 1 if m[1] else 2
        if not ROLES.match(m[g]):
            add(*m.span(g), "name")
    for m in NAME_RUNNING.finditer(text):
        g = 1 if m[1] else 2
        if not ROLES.match(m[g]):
            add(*m.span(g), "name")
    for m in NAME_EN.finditer(text):
        g = next(i for i in (1, 2, 3) if m[i])
        words = re.findall(r"[A-Za-z]+", m[g])
        a, b = m.span(g)
        if len(words) > 2 and words[-1] in STARTS:  # the next sentence has begun
            b = a + m[g].rfind(words[-1])
            b = a + len(text[a:b].rstrip())
            words = words[:-1]
        if words[0] not in STARTS and words[-1] not in STARTS and len(words) > 1:
            add(a, b, "name")
    for m in NAME_FIRST.finditer(text):
        add(*m.span(), "name")
    return sorted(found)


# -- entities --------------------------------------------------------------------------------


def canonical(kind: str, value: str) -> str:
    """One form for all spellings of an entity; a phone number with the code of its country, without a trunk 0."""
    s = unicodedata.normalize("NFKC", value)
    if kind == "email":
        return re.sub(r"[\[({<\s]*\bat\b[\])}>\s]*", "@", re.sub(r"[\[({\s]*\bdot\b[\])}\s]*", ".", re.sub(r"\s?@\s?", "@", s.lower())))
    if kind == "id_number":
        return s.replace(" ", "").upper()
    if kind == "phone":
        digits = re.sub(r"\D", "", s)
        if re.match(r"\(?(?:\+|00)", s) or len(digits) == 13 and digits.startswith("86"):
            digits = digits.removeprefix("00")
            code = next((c for c in ("86", "1") if digits.startswith(c)), "")
            return f"{code}-{digits[len(code):].removeprefix('0')}"
        if digits.startswith("0"):
            return f"86-{digits[1:]}"
        if len(digits) == 11 and digits.startswith("1"):
            return f"1-{digits[1:]}" if re.match(r"1\D", s) else f"86-{digits}"
        return f"1-{digits}"
    if kind == "address":
        return re.sub(r"\s+", " ", s).lower()
    if "," in s:
        last, first = (x.strip() for x in s.split(",", 1))
        s = f"{first} {last}"
    return re.sub(r"\s+", " ", s).lower()


def gender_of(text: str, a: int, b: int) -> str:
    """m, f or unknown, from the title at a name."""
    before, after = text[max(0, a - 5) : a], text[b : b + 2]
    if after == "先生" or re.search(r"\bMr\.?\s$", before):
        return "m"
    return "f" if after in ("女士", "小姐") or re.search(r"\b(?:Mrs|Ms|Miss)\.?\s$", before) else ""


def entities(text: str) -> list[dict]:
    """Every mention with its entity. A name of three signs or more that some sign gives away is
    followed through the whole text: what is written alike elsewhere in it is the same person."""
    spans = mentions(text)
    taken = np.zeros(len(text) + 1, bool)
    for a, b, _ in spans:
        taken[a:b] = True
    for name in {text[a:b] for a, b, k in spans if k == "name" and b - a > 2}:
        edge = r"\b" if name[0].isascii() else ""
        for m in re.finditer(edge + re.escape(name) + edge, text):
            if not taken[m.start() : m.end()].any():
                taken[m.start() : m.end()] = True
                spans.append((m.start(), m.end(), "name"))
    return [{"kind": k, "canon": canonical(k, text[a:b]), "value": text[a:b], "gender": gender_of(text, a, b) if k == "name" else "", "start": a, "stop": b} for a, b, k in sorted(spans)]


# -- surrogates ------------------------------------------------------------------------------


def _draw(key: str, kind: str, canon: str) -> Callable[[int], int]:
    """A keyed source of numbers that belongs to an entity: each call gives one below its argument."""
    own = hashlib.blake2b(f"{kind}\x1f{canon}".encode(), key=hashlib.blake2b(key.encode()).digest(), digest_size=16).digest()
    state = int.from_bytes(hashlib.shake_128(own).digest(160), "big")

    def below(n: int) -> int:
        nonlocal state
        state, x = divmod(state, n)
        return x

    return below


#: Parts of surrogates. Latin names are made of syllables, others of GIVEN.
ENDINGS = {"m": "an on us ard er o".split(), "f": "a ia ine elle ette ena".split(), "": "en is y ey in el".split()}
SURNAMES = "son ley ton man ford well wood field worth by stone ham".split()
ONSETS, VOWELS, CODAS = "bdfghjklmnprstvw", "aeiou", "lmnrstdbv"


def _syllables(below: Callable[[int], int]) -> str:
    pick = lambda pool: pool[below(len(pool))]
    return (pick(ONSETS) + pick(VOWELS) + pick(CODAS) + (pick(VOWELS) + pick(CODAS) if below(2) else "")).capitalize()


def _written(value: str, new: str, keep: int) -> str:
    """``new`` digits in the places of a value's digits after the first ``keep``, in their width."""
    pool, out, seen = iter(new), [], 0
    for c in value:
        if c.isdigit() or c in "XxＸｘ" and len(new) == 18:
            seen += 1
            if seen > keep:
                d = next(pool, "0")
                c = chr(ord(d) + 0xFEE0) if ord(c) > 0xFF00 else d
        out.append(c)
    return "".join(out)


def surrogate(kind: str, value: str, canon: str, gender: str, key: str) -> str:
    """A keyed stand-in of the same kind, script and format; depends on the entity and its form alone."""
    below = _draw(key, kind, canon)
    pick = lambda pool: pool[below(len(pool))]
    if kind == "phone":  # country, trunk 0 and type of line stay readable, the number does not
        own = canon.partition("-")[2]
        new = own[:2] + "".join(str(below(10)) for _ in own[2:])
        return _written(value, new, sum(c.isdigit() for c in value) - len(own))
    if kind == "id_number":  # a citizen number with a date, the same sex and a valid check character
        body = f"{1 + below(8)}{below(100000):05d}{1940 + below(70)}{1 + below(12):02d}{1 + below(28):02d}{below(100):02d}{2 * below(5) + int(canon[16]) % 2}"
        return _written(value, body + check_character(body), 0)
    if kind == "email":
        user = "".join(chr(97 + below(26)) for _ in range(10))
        return f"{user}@example.invalid".upper() if value.isupper() else f"{user}@example.invalid"
    han = re.search(_H, value)
    if kind == "address":
        if han:
            pool = GIVEN[""]
            head = f"{pick(pool)}{pick(pool)}{m[0]}" if (m := re.search(r"[市县区镇]", value)) else ""
            street = f"{pick(pool)}{pick(pool)}"
            road = re.search(rf"{STREET}(?={_D})", value)
            number = re.sub(_D, lambda _: str(below(9) + 1), value[road.end() :] if road else "1号")
            return f"{head}{street}{road[0] if road else '路'}{number}"
        tail = re.search(r" (\w+\.?)(,.*| (?:unit|apt|apartment|suite|room|flat|floor|#).*)?$", value, re.I)
        return f"{below(90) + 10} {_syllables(below)}{pick(SURNAMES)} {tail[1] if tail else 'Road'}" + re.sub(r"\d", lambda _: str(below(9) + 1), tail[2] or "" if tail else "")
    if han:
        family = pick(FAMILY[19:] if value[:2] not in FAMILY[:19] else FAMILY[:19])
        return family + "".join(pick(GIVEN[gender]) for _ in range(len(value) - len(family)))
    first, last = _syllables(below) + pick(ENDINGS[gender]), _syllables(below) + pick(SURNAMES)
    middle = "".join(f" {chr(65 + below(26))}." for _ in range(len(re.findall(r"\b[A-Za-z]\.", value)) - (value[1:2] == ".")))
    if "," in value:
        return f"{last}, {first}{middle}"
    return f"{first[0]}.{middle} {last}" if value[1:2] == "." else f"{first}{middle} {last}"


def personal_found(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, kind, value), distinct: every mention exactly as written."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(i, k, v) for i, t in enumerate(b.column(1).to_pylist()) if t for k, v in {(e["kind"], e["value"]) for e in entities(t)}]
            if out:
                at, kinds, values = zip(*out)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(kinds), pa.array(values)], names=["id", "kind", "value"])

    slim = spread(df.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")).where("text is not null"))
    schema = T.StructType([T.StructField("id", slim.schema["id"].dataType), T.StructField("kind", T.StringType()), T.StructField("value", T.StringType())])
    return slim.mapInArrow(rows, schema).distinct().withColumnRenamed("id", id)


_MENTION = "array<struct<kind:string,canon:string,value:string,gender:string,start:int,stop:int>>"


def settled(found: DataFrame, key: str) -> DataFrame:
    """(kind, canon, gender, rank) of the entities that have a gender or clash with another's surrogate.

    The gender is that of most titles of an entity, none if they are as many. Entities that drew the
    same surrogate are ranked by their canonical form; the space of surrogates keeps such groups small.
    """
    each = found.select(F.explode("found").alias("m")).select("m.*")
    lead = F.count_if(F.col("gender") == "m") - F.count_if(F.col("gender") == "f")
    distinct = each.groupBy("kind", "canon").agg(F.when(lead > 0, "m").when(lead < 0, "f").otherwise("").alias("gender"))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            forms = [surrogate(k, c.partition("-")[2] if k == "phone" else c, c, g, key) for k, c, g in zip(*(x.to_pylist() for x in b.columns))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(forms, pa.string())], names=["kind", "canon", "gender", "form"])

    drawn = distinct.mapInArrow(draw, "kind string, canon string, gender string, form string")
    rank = F.row_number().over(Window.partitionBy("kind", "form").orderBy("canon"))
    return drawn.withColumn("rank", rank).where("gender <> '' or rank > 1").select("kind", "canon", "gender", "rank")


def redact(df: DataFrame, key: str, id: str = "doc_id", text: str = "text", at_once: int = 500_000) -> DataFrame:
    """(id, text) with every mention replaced by a typed placeholder that holds its surrogate.

    ``key`` is the secret of the surrogates: the same key gives the same stand-ins in every run. Up
    to ``at_once`` entities that have a gender or clash are broadcast and no text moves; more of
    them are joined to the mentions and these to their texts, with the same result.
    """
    if not key:
        raise ValueError("surrogates need a key")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("canon", pa.string()), ("value", pa.string()), ("gender", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
        for b in batches:
            out = [entities(t) if t else [] for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(out, kind)], names=["row", "id", "text", "found"])

    slim = spread(df.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))).select(F.monotonically_increasing_id().alias("row"), "id", "text")
    schema = T.StructType([*slim.schema.fields, T.StructField("found", T._parse_datatype_string(_MENTION))])
    rows = stage(slim.mapInArrow(scan, schema), "personal-rows")
    special = stage(settled(rows, key), "personal-entities")
    out = T.StructType([slim.schema["id"], slim.schema["text"]])

    def replaced(t: str, found: list[dict], more: Callable[[int, dict], tuple[str, int]]) -> str:
        parts, done = [], 0
        for i, e in enumerate(found):
            gender, rank = more(i, e)
            new = surrogate(e["kind"], e["value"], e["canon"], gender, key)
            parts += [t[done : e["start"]], f"[{e['kind'].upper()}:{new}{f'~{rank}' if rank > 1 else ''}]"]
            done = e["stop"]
        return "".join([*parts, t[done:]]) if found else t

    if special.count() <= at_once:
        table = {(r.kind, r.canon): (r.gender, r.rank) for r in special.toLocalIterator()}
        shared = df.sparkSession.sparkContext.broadcast(table)

        def splice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                own = shared.value
                new = [replaced(t, found, lambda _, e: own.get((e["kind"], e["canon"]), ("", 1))) for t, found in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(new, pa.string())], names=["id", "text"])

        done = rows.select("id", "text", "found").mapInArrow(splice, out)
    else:

        def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                new = []
                for t, found, more in zip(*(b.column(i).to_pylist() for i in (1, 2, 3))):
                    at = {x["at"]: (x["gender"], x["rank"]) for x in more or ()}
                    new.append(replaced(t, found, lambda i, _: at.get(i, ("", 1))))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(new, pa.string())], names=["id", "text"])

        each = rows.select("row", F.posexplode("found").alias("at", "m")).select("row", "at", "m.kind", "m.canon")
        more = each.join(special, ["kind", "canon"]).groupBy("row").agg(F.collect_list(F.struct("at", "gender", "rank")).alias("more"))
        done = rows.join(more, "row", "left").select("id", "text", "found", "more").mapInArrow(join, out)
    return done.withColumnRenamed("id", id).withColumnRenamed("text", text)
