"""Problem 6: defective responses among prompt and response pairs.

A response is read without its markup and in the one form of characters. In this order, the
first defect that holds is given:

* ``empty``: nothing, or only a stand-in for missing content (a null answer; a null memo is none);
* ``refusal``: a refusal grammar (a sentence that declines, politely or as a speaker, then grounds) reads it;
* ``copy``: greedy string tiling covers most of it by the prompt, and most of the prompt's stem;
* ``language``: script and function words show another language than the prompt's;
* ``truncated``: a pushdown parser over fences, formulas, environments, brackets and quotations
  ends with something open, or the last statement breaks off inside a sentence.

Scale: rows are independent; one pass, no shuffle. Tiling runs only where as many letters and
6-grams of the response occur in the prompt as any such tiling needs; matches come from one order of all suffixes, at every length.

Defined results: a null prompt is treated as empty (nothing can copy it, it has no language);
repeated rows repeat their defects; texts of any length are read whole.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from sheafline.llm.letters import letters
from sheafline.llm.lookalikes import unify
from sheafline.llm.markup import START, parse
from sheafline.session import spread

#: What stands in for missing content, as letters, digits and dots.
STAND_INS = frozenset(
    "null none nil nan na n/a tbd todo undefined unknown empty missing pending 略 无 空 暂无 暂缺 待补 待补充 待完善 待定 待更新 待录入 待填 未知 未填 未提供 缺失 缺 见解析 暂无答案 暂无解析 无答案 无解析 答案暂缺 解析暂缺 此处略 答案略 解析略 省略 нет".split()
)
LEADS = re.compile(r"^(?:参考答案|标准答案|答案|解答|解析|分析|详解|答|解|点评|回答|题目|原题|问题|题干|本题题目|answer|solution|explanation|question|response|ответ|решение|antwort|lösung|こたえ|解説)\s*(?:如下)?\s*[:：]?\s*", re.I)

# -- refusals --------------------------------------------------------------------------------
_CORE = (
    r"恕(?:不|难|我不能|我无法|无法)|不便(?:作答|回答|提供|透露|解答)|(?:无法|不能|没法|难以)(?:直接|继续|再)?(?:为您|为你|帮您|帮你|帮助|给您|向您)?(?:给出|提供|回答|解答|作答|完成|协助|透露|处理)(?!.{0,8}(?:动力|电流|电压|能量))"
    r"|没有办法(?:帮|为|回答|提供|完成)|婉拒|拒绝(?:回答|提供|作答)|超出了?(?:我|本)?.{0,6}(?:范围|能力|权限)|不具备.{0,8}(?:能力|权限)|不予(?:透露|提供|公布|解答|回答)|不(?:可以|应|会)(?:提供|透露|给出).{0,6}(?:答案|解答)|不在我.{0,8}范围|爱莫能助|无可奉告"
    r"|\b(?:unable|not able|not allowed|not permitted) to (?:answer|help|assist|provide|solve|respond|do|comply|complete|share|give)|\b(?:can(?:no|['’])?t|cannot|won['’]t|will not|must not|may not|could not) (?:help|assist|provide|answer|solve|respond|comply|share|give|do that|complete|offer|discuss)|\b(?:must|have to|need to|respectfully|i) decline\b|is not something (?:i|we) (?:can|am)|outside (?:of )?(?:what|my|the scope)|beyond (?:my|what i)|against (?:my|the) (?:policy|rules|guidelines)"
    r"|не (?:могу|в состоянии|буду|имею права) (?:помочь|ответить|отвечать|решить|предоставить|дать)|вынужден отказать|kann (?:ich )?(?:.{0,30})?nicht (?:beantworten|helfen|lösen|bereitstellen)|(?:お答え|回答|お手伝い|提供|対応)(?:は|を)?(?:でき|いたし|し)(?:ません|かねます)|no puedo (?:ayudar|responder|proporcionar)|je ne peux pas (?:vous )?(?:aider|répondre|fournir)|답변(?:할 수 없|드릴 수 없)"
)
CORE = re.compile(_CORE, re.I)
#: What a core holds somewhere, so that most texts are passed over without trying it.
_HINT = re.compile(r"恕|不便|婉拒|拒绝|超出|不具备|不予|爱莫|无可奉|不在我|没有办法|(?:无法|不能|没法|难以)(?:直接|继续|再)?(?:为|帮|给|向|提|回|解|作|完|协|透|处)|不(?:可以|应|会)(?:提供|透露|给出)")
_HINTS = ("unable", "not able", "not allowed", "not permitted", "can't", "can’t", "cannot", "can not", "won't", "won’t", "will not", "must not", "may not", "could not", "decline", "not something", "outside", "beyond", "against", "не ", "отказ", "nicht", "できません", "かねます", "puedo", "peux pas", "없")
POLITE = re.compile(r"抱歉|对不起|很遗憾|遗憾|您好|你好|不好意思|作为(?:一个|一名)?.{0,6}(?:助手|模型|人工智能)|请(?:您)?(?:咨询|谅解|理解|换|查阅|自行)|敬请谅解|建议|可以换|sorry|apologi[sz]e|unfortunately|as an? (?:ai|assistant|language model)|please|i'm afraid|извините|к сожалению|простите|leider|tut mir leid|申し訳|すみません|lo siento|désolé|죄송", re.I)
#: Who declines.
SPEAKER = re.compile(r"我|本(?:助手|模型|系统|平台)|\b(?:i|we|ich|wir|je|nous|yo|no)\b|(?<!\w)(?:я|мы)(?!\w)|私|저", re.I)
#: What a sentence of a solution holds: an equation, a formula, a choice, a conclusion, a value with its unit.
WORKED = re.compile(r"[=＝≈∝]|\$[^$]+\$|\\\(|解得|代入|联立|故选|(?:答案|选项?)[是为]?\s*[A-I]\b|\d\s*(?:[A-Za-zμΩ]{1,3}\b|°)")
_SENTENCE = re.compile(r"[^。！？!?\n]+")


def refuses(text: str) -> bool:
    """The refusal grammar: one of the first two sentences or the last declines (a core beside
    politeness or a speaker, or little but a core), and grounds may follow at any length, but no solution."""
    parts = [x for x in _SENTENCE.findall(text) if letters(x)]
    size = [len(letters(x)) for x in parts]
    if not parts or sum(n for x, n in zip(parts, size) if WORKED.search(x)) > 0.25 * sum(size):
        return False
    for k in {0, 1, len(parts) - 1} & set(range(len(parts))):
        m = CORE.search(parts[k])
        if m and (POLITE.search(" ".join(parts[max(0, k - 1) : k + 2])) or SPEAKER.search(parts[k]) or len(letters(CORE.sub("", parts[k]))) <= 0.75 * size[k]):
            return True
    return False

# -- languages -------------------------------------------------------------------------------
_NO_WORDS = re.compile(r"(?s)```.*?(?:```|\Z)|`[^`\n]*`|\$[^$]*\$|\\\(.*?\\\)|!?\[[^\]\n]*\]\([^)\n]*\)|https?://\S+|\[[\w.]+\]|\b[\w.+\-]+@[\w.\-]+\b|\d[\d.,]*\s*[A-Za-zμΩ°/²³·]{1,6}\b")
#: Frequent function words that tell languages in Latin script apart.
FUNCTION_WORDS = {
    "en": frozenset("the of is and at from to so for this that by a an on in with it as be are was needs equals hence how what correct option because moves".split()),
    "de": frozenset("der die das den dem des und ist von eine ein einer sich nach bleibt weil nicht mit auf für aus beträgt daraus folgt im zu wird".split()),
    "fr": frozenset("le la les des est une un du et que dans pour par sur avec donc nous il qui au".split()),
    "es": frozenset("el los las es una un del y que en por para con se al lo como su".split()),
}
_UNITS = frozenset("km cm mm kg mg kn hz khz mhz mv kv ma kw mw min ms mt kpa pa nc mc rad mol lux wb ev kj mj figs fig png jpg svg ux sin cos tan log ln".split())


_EAST = re.compile(r"[ぁ-んァ-ヴー一-鿿㐀-䶿]")
_KANA = re.compile(r"[ぁ-んァ-ヴー]")
_SCRIPTS = re.compile(r"[^\W\d_ぁ-んァ-ヴー一-鿿㐀-䶿]")
#: Runs of signs outside Latin, Han and kana; their letters (marks stand between those of some scripts) make a word from two on.
_OTHERS = re.compile(r"[^\s\x00-ɏぁ-んァ-ヴー一-鿿㐀-䶿]{2,}")


@functools.cache
def script(c: str) -> str:
    """The script of a letter, by the first word of its name."""
    return unicodedata.name(c, "").partition(" ")[0].lower()


def language(text: str) -> str:
    """The main language of a text, or nothing where letters, values and formulas have none."""
    east = len(_EAST.findall(text))
    kana = len(_KANA.findall(text))
    if east >= 8 and east > len(_SCRIPTS.findall(text)):  # no formula or unit can weigh this up
        return "ja" if kana > 0.2 * east else "zh"
    text = _NO_WORDS.sub(" ", text)
    kana = len(re.findall(r"[ぁ-んァ-ヴー]", text))
    han = len(re.findall(r"[一-鿿㐀-䶿]", text))
    words = [w for w in re.findall(r"[A-Za-zÀ-ɏ]+(?:['’][A-Za-z]+)?", text) if len(w) > 1 and w.lower() not in _UNITS or w in ("a", "I", "A")]
    latin = sum(map(len, words)) if any(len(w) > 2 for w in words) else 0
    east = 2.5 * (han + kana)
    weight: Counter = Counter({"east": east, "latin": latin})
    for word in _OTHERS.findall(text):
        for c in filter(str.isalpha, word):
            weight[script(c)] += 2.5 if "가" <= c <= "힣" else 1
    best = max(weight, key=weight.get)
    if weight[best] < 8:
        return ""
    if best == "east":
        return "ja" if kana > 0.2 * (han + kana) else "zh"
    if best != "latin":
        return best
    low = [w.lower() for w in words]
    hits = {k: sum(w in v for w in low) for k, v in FUNCTION_WORDS.items()}
    hits["de"] += sum(bool(re.search("[äöüß]", w)) for w in low)
    top = max(hits, key=hits.get)
    return top if hits[top] else ("" if len(words) < 2 else "latin")


# -- copies ----------------------------------------------------------------------------------


def longest_matches(a: str, b: str) -> tuple[np.ndarray, np.ndarray]:
    """For every place of ``a`` the longest text from there that occurs in ``b``, and one place where it does.

    Suffixes of both are ranked together by prefix doubling; the best match of a suffix of ``a`` is
    the nearest suffix of ``b`` before or after it in that order.
    """
    n, m = len(a), len(b)
    code = np.frombuffer(f"{a}\0{b}\1".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    size, levels = len(code), []
    rank, width = np.unique(code, return_inverse=True)[1].astype(np.int64), 1
    while True:
        levels.append((width, rank.astype(np.int32)))
        after = np.append(rank[width:], np.full(min(width, size), -1)) if width < size else np.full(size, -1)
        pair = rank * (size + 1) + after + 1
        if width >= size or rank.max() == size - 1:
            break
        rank, width = np.unique(pair, return_inverse=True)[1].astype(np.int64), 2 * width
    order = np.argsort(rank, kind="stable")
    place = np.empty(size, np.int64)
    place[order] = np.arange(size)
    other = order > n
    before = np.maximum.accumulate(np.where(other, np.arange(size), -1))
    behind = np.minimum.accumulate(np.where(other, np.arange(size), size)[::-1])[::-1]
    best, at = np.zeros(n, np.int64), np.full(n, -1)
    own = np.arange(n)
    for near in (before[place[:n]], behind[place[:n]]):
        there = (near >= 0) & (near < size)
        x, y = own.copy(), np.where(there, order[np.clip(near, 0, size - 1)], size)
        for w, level in reversed(levels):
            fits = (x + w <= n) & (y + w <= size - 1)
            same = np.flatnonzero(fits)[level[x[fits]] == level[y[fits]]]
            x[same] += w
            y[same] += w
        longer = (x - own > best) & there
        best[longer] = (x - own)[longer]
        at[longer] = (y - (x - own))[longer] - n - 1
    return best, at


def tiling(a: str, b: str, least: int = 6) -> int:
    """Characters of ``a`` covered by greedy string tiling with ``b``: longest common tiles first, no
    character of either in two tiles."""
    if len(a) < least or len(b) < least:
        return 0
    best, at = (x.tolist() for x in longest_matches(a, b))
    runs, i = [], 0
    while i <= len(a) - least:
        if best[i] >= least:
            runs.append((best[i], i, at[i]))
            i += best[i] - least + 1
        else:
            i += 1
    used_a, used_b, covered = bytearray(len(a)), bytearray(len(b)), 0
    for k, i, j in sorted(runs, reverse=True):
        while k and (used_a[i] or used_b[j]):
            i, j, k = i + 1, j + 1, k - 1
        size = next((x for x in range(k) if used_a[i + x] or used_b[j + x]), k)
        if size >= least:
            used_a[i : i + size] = used_b[j : j + size] = b"\1" * size
            covered += size
    return covered


def stem(prompt: str) -> str:
    """A prompt without its options: what stands before a label A that a label B follows."""
    at = prompt.find("A")
    while at >= 0:
        before, after = prompt[at - 1 : at], prompt[at + 1 : at + 2]
        if after and (before in ("（", "(") and after in "）)" or after in "．、." and not (before.isascii() and before.isalnum())):
            end = at - (before in ("（", "("))
            if end and any(prompt.find(label, at) > 0 for label in ("B）", "B)", "B．", "B、", "B.")):
                return prompt[:end]
        at = prompt.find("A", at + 1)
    return prompt


def copies(response: str, prompt: "Prompt") -> bool:
    """Tiles of the prompt cover most of a response and, of a short one, most of the prompt's stem too."""
    own = letters(LEADS.sub("", response))
    n, held = len(own), prompt.signs
    if n < 6 or n < 0.4 * len(prompt.stem) or sum(c in held for c in own) < 0.8 * n:
        return False
    grams = prompt.grams  # every tile of six letters or more shows as one of these at least
    if sum(own[i : i + 6] in grams for i in range(n - 5)) < 0.8 * n / 6 or tiling(own, prompt.letters) < 0.8 * n:
        return False
    return tiling(prompt.stem, own) >= (0.4 if n >= 16 else 0.8) * len(prompt.stem)


# -- truncation ------------------------------------------------------------------------------
_STOPS = "。．！？!?；;…：:"
_CLOSERS = "”’」』）)】]》>}\"'`*"
_VALUE = re.compile(r"(?:[-+−±]?\d[\d.,]*(?:\s*[×x]\s*10\^?[-−]?\d+)?\s*(?:[A-Za-zμΩ°℃%‰][A-Za-zμΩ°/²³·^\-\d]{0,7})?|[A-Z]|\$[^$]*\$|\\\([^\n]*?\\\)|[\w]+\s*=\s*\S+)$")
_FINISHED = re.compile(r"(?:略去|不变|守恒|可知|正确|错误|成立|减小|增大|变小|变大|相等|相同|不同|为零|无关|有关|平衡|静止|选项?[A-I]+|完毕|证毕|得证|即可|如下|所示|为准|左右|所求|附注|图表|个单位|倍|另列|另计|联立|correct|wrong|true|false|zero|constant|done|rest|equal|unchanged)$", re.I)
#: A value alone, after a label or a picture at most, and its direction: a short answer.
_DIRECTED = re.compile(r"(?:^|[:：)）\]】*])\s*[-+−±]?\d[\d.,]*\s*[A-Za-zμΩ°/²³·]{0,6}\s*[，,]?\s*[^，,。\d]{0,8}$")
#: What may come after a response and says nothing about it: how it ends, how it begins, its form where
#: that is not all it takes. Tables, code, pictures, links, tags, entities.
_TAILS = (
    ("</pre>", "<pre", None),
    ("</table>", "<table", None),
    ("-->", "<!--", None),
    (">", "<", re.compile(r"</?[A-Za-z][^<>]*>")),
    ("&gt;", "&lt;", re.compile(r"&lt;/?[A-Za-z][^&<>]*&gt;")),
    (";", "&", re.compile(r"&#?\w{1,32};")),
    ("|}", "{|", None),
    ("}}", "{{", None),
    ("}", "\\end{", re.compile(r"\\end\{(equation|align|gather|tabular|verbatim)(\*?)\}")),
    ("}", "\\onepicture", re.compile(r"\\onepicture(?:\[[^\]\n]*\])?\{[^{}]*\}")),
    ("}", "\\includegraphics", re.compile(r"\\includegraphics(?:\[[^\]\n]*\])?\{[^{}]*\}")),
    ("}", "\\quad", re.compile(r"\\quad\s*[\d.]+\s*\\,\s*\\mathrm\{[^{}]*\}")),
    (")", "[", re.compile(r"\[[^\]\n]*\]\([^()\s]+\)")),
    ("|", "\n", re.compile(r"\n[ \t]*\|[^\n]*\|")),
    ("```", "```", None),
)
_LINK_LEAD = re.compile(r"见?!?\Z")


def strip_appended(raw: str) -> str:
    """A response without what is appended to it; every step takes one mark off the end.

    Places only move forward to the beginning, so each opening sign is looked for once.
    """
    end, last = len(raw), {}

    def before(sign: str, end: int) -> int:
        at = last.get(sign)
        if at is None or at + len(sign) > end:
            last[sign] = at = raw.rfind(sign, 0, end)
        return at

    while True:
        while end and raw[end - 1].isspace():
            end -= 1
        for mark, sign, form in _TAILS:
            if not raw.endswith(mark, 0, end):
                continue
            at = before(sign, end - len(mark))
            if mark == "|" and at < 0 and re.fullmatch(r"[ \t]*\|[^\n]*\|", raw[:end]):
                return ""
            if at < 0 or form and not (m := form.fullmatch(raw, at, end)):
                continue
            if sign == "\\end{":  # the whole environment goes, from where it begins
                at = raw.rfind(f"\\begin{{{m[1]}{m[2]}}}", 0, at)
                if at < 0:
                    continue
            if sign == "[":
                at -= len(_LINK_LEAD.search(raw, max(0, at - 2), at)[0])
            end = at
            break
        else:
            return raw[:end]


_SUP = re.compile(r"<sup>\s*\[?\d{1,3}\]?\s*</sup>(?=\s*(?:</\w+>|&\S+;|<!--.*?-->|\s)*$)", re.S)
_BRACKETS = {")": "(", "）": "（", "]": "[", "】": "【", "}": "{", "”": "“", "』": "『", "」": "「", "》": "《"}


_ENDS = frozenset("。！？!?…")


class Pushdown:
    """Reads fences, formulas, environments, brackets and quotations; ``open`` is what is left on the stack."""

    _TOKENS = re.compile(r"```|\$\$|(?<!\\)\$|\\\(|\\\)|\\begin\{([^{}]*)\}|\\end\{([^{}]*)\}|[()（）\[\]【】{}“”「」『』《》]")

    def __init__(self, text: str):
        stack: list[str] = []
        for m in self._TOKENS.finditer(text):
            t = m[0]
            inner = stack[-1] if stack else ""
            if inner in ("```", "$", "$$", "\\("):  # inside these only their own end counts
                if t == inner or inner == "\\(" and t == "\\)":
                    stack.pop()
                continue
            if t in ("```", "$", "$$", "\\("):
                stack.append(t)
            elif m[1] is not None:
                stack.append("begin:" + m[1])
            elif m[2] is not None:
                if "begin:" + m[2] in stack:
                    while stack.pop() != "begin:" + m[2]:
                        pass
            elif t in _BRACKETS:
                if _BRACKETS[t] in stack:  # what was opened inside and never closed goes with it
                    while stack.pop() != _BRACKETS[t]:
                        pass
            elif t != "\\)":
                stack.append(t)
        self.open = stack


def truncated(raw: str, clean: str) -> bool:
    tail = clean.rstrip()
    if not tail:
        return False
    core = tail.rstrip(_CLOSERS + " ")
    last = core[-1:] if core else tail[-1]
    if tail[-1] in "。！？!?；;…" or last in "。！？!?…" or tail[-1] == "." or tail.endswith("```"):
        return False
    if "$" in Pushdown(tail).open or "\\(" in Pushdown(tail).open:
        return True
    if tail[-1] in ",，、：:（(“「《=＝+−×÷<>≤≥≈" or last in ",，、":
        return True
    line = tail.rpartition("\n")[2]
    line = re.sub(r"^(?:[-*+>#]+\s*)+", "", line)
    if "|" in line:
        return False
    sentence = re.split(r"[。！？!?；;]|\.\s", line)[-1].strip()
    if not sentence:
        return False
    if any(x in "（(“「『《【" for x in Pushdown(tail).open) and tail[-1] not in _CLOSERS:
        return True
    if tail[-1] in _CLOSERS and not re.search(r"[\w\d]\*?$", sentence):
        return False
    if _VALUE.search(sentence):
        m = _VALUE.search(sentence)
        before = sentence[: m.start()].rstrip()
        if not before:
            return False
        clause = re.split(r"[，,]", sentence)[-1].strip()
        return bool(re.match(r"(?:在|当|第)\s*[\d.]+\s*\S{0,4}$", clause)) and not re.match(r"^(?:第\s*\d+)$", sentence)
    if _FINISHED.search(sentence) or _DIRECTED.search(sentence):
        return False
    if len(letters(sentence)) <= 3 and len(letters(clean)) <= 3:
        return False
    han = bool(re.search(r"[一-鿿]$", sentence))
    words = re.findall(r"[^\W\d_]+", sentence)
    if han:
        return len(re.findall(r"[一-鿿]", sentence)) >= 2
    if re.search(r"[ぁ-んァ-ヴー]$", sentence):
        return not re.search(r"(?:る|た|す|い|ん|だ)$", sentence)
    # a single small letter after running words is the beginning of a word
    return len(words) >= 2 and bool(re.search(r"[^\W\d_]{2,}$|\b[aI]$|[a-z]{2,}[ ,]+(?:[a-z]{2,}[ ,]+)+[b-z]$", sentence))


# -- rows ------------------------------------------------------------------------------------


def hinted(text: str) -> bool:
    low = text.lower()
    return bool(_HINT.search(text)) or any(h in low for h in _HINTS)


def plain(raw: str) -> str:
    """A text without markup in the one form of characters."""
    return unify(parse(raw).text() if START.search(raw) else raw)[0]


def defect(response: str | None, prompt: "Prompt", null_is_empty: bool) -> str | None:
    """The defect of one response, or nothing."""
    if response is None:
        return "empty" if null_is_empty else None
    if len(response) < 10 and response.isascii() and response.isalpha() and response.isupper() and response <= "I":
        return None  # option letters
    clean = plain(response).strip()
    bare = LEADS.sub("", clean).strip()
    if len(bare) < 24:
        key = re.sub(r"[^\w/.…]+|_", "", bare).lower().strip(".…/")
        if not key and "![](" not in clean and not re.search(r"[=<>×√±∝∞\d]", bare) or key in STAND_INS:
            return "empty"
        if re.fullmatch(r"[A-I]{1,9}|[\d.\s]+[^\W\d]{0,4}", bare):
            return None
    if hinted(clean) and CORE.search(clean) and refuses(clean):
        return "refusal"
    if copies(clean, prompt):
        return "copy"
    own = language(bare)
    if own and prompt.language and own != prompt.language and "latin" not in (own, prompt.language):
        return "language"
    if own == "latin" and prompt.language not in ("", "latin", *FUNCTION_WORDS):
        return "language"
    if clean[-1:] in _ENDS:  # nothing breaks off
        return None
    mark = len(response)
    while (mark := response.rfind("!", 0, mark)) >= 0 and response[mark + 1 : mark + 2] == "[":  # a picture is no end
        pass
    stop = max(mark, *(response.rfind(c) for c in _ENDS if c != "!")) + 1  # what is appended stands after the last full stop
    raw = response[:stop] + strip_appended(_SUP.sub("", response[stop:]))
    if "\\\\ " in raw:
        raw = raw.rpartition("\\\\ ")[0]
    end = clean if raw == response else plain(raw).strip()
    return "truncated" if truncated(raw, end) else None


class Prompt:
    """What is compared of a prompt, made once for its responses and only where one of them needs it."""

    def __init__(self, raw: str | None):
        self.raw = raw or ""

    @functools.cached_property
    def clean(self) -> str:
        return plain(self.raw)

    @functools.cached_property
    def letters(self) -> str:
        return letters(self.clean)

    @functools.cached_property
    def signs(self) -> frozenset[str]:
        return frozenset(self.letters)

    @functools.cached_property
    def grams(self) -> frozenset[str]:
        return frozenset(self.letters[i : i + 6] for i in range(len(self.letters) - 5))

    @functools.cached_property
    def stem(self) -> str:
        return letters(stem(self.clean)) or self.letters

    @functools.cached_property
    def language(self) -> str:
        return language(self.clean)


def defects_found(df: DataFrame, id: str = "item_id", prompt: str = "body", answer: str = "answer", memo: str = "memo") -> DataFrame:
    """(id, field, defect) of every defective response."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, (p, *responses) in enumerate(zip(*(b.column(k).to_pylist() for k in (1, 2, 3)))):
                own = Prompt(p)
                for field, r, null in (("answer", responses[0], True), ("memo", responses[1], False)):
                    if d := defect(r, own, null):
                        out.append((i, field, d))
            if out:
                at, fields, kinds = zip(*out)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(fields), pa.array(kinds)], names=["id", "field", "defect"])

    slim = spread(df.select(F.col(id).alias("id"), *(F.col(c).cast("string").alias(n) for c, n in ((prompt, "p"), (answer, "a"), (memo, "m")))))
    schema = T.StructType([T.StructField("id", slim.schema["id"].dataType), T.StructField("field", T.StringType()), T.StructField("defect", T.StringType())])
    return slim.mapInArrow(rows, schema).withColumnRenamed("id", id)
