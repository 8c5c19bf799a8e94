"""One consistent form for text that looks the same but is stored in different characters.

Each token's resolved script set is the intersection of the script sets of its letters, where a
letter counts with every script that has a letter of its shape. If the letters as written share no
script (mixed-script), the token is spelled in the script that can spell all of it. A token whose
every letter has a twin in another script (whole-script confusable) is spelled in the script of
the nearest token before it, else after it, that has only one; where there is none, in Latin.
Kana and ideographs of one shape are resolved in the same way, by the characters beside their run.
What is left is brought to one form: widths, accents put together or apart, invisible characters,
spaces, hyphens, ligatures, doubled code points of one ideograph.

Every choice looks only at shapes, never at which twin is stored, so texts that look the same come
to one form whatever their context, and texts of one consistent script stay as they are.

Compatibility forms that look different (superscripts, circled and squared characters, fractions,
bold letters) stay as they are, as do case, digits, signs, dashes and line breaks other than CR LF.
A letter never becomes a digit.

Defined results: null stays null, empty and blank stay what they are; texts are handled whole. For
pairs, rows without a key or without text take no part, and rows that come twice count once.
"""

from __future__ import annotations

import re
import unicodedata as ud
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import cut

#: Letters of other scripts and the Latin letters of the same shape.
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοϲϳν", "ABEZHIKMNOPTYXocjv", strict=True))
CYRILLIC = dict(zip("АВЕІЈКМНОРСТУХЅҮЬԌԚԜаеорсухѕіјһԁԛԝӏү", "ABEIJKMHOPCTYXSYbGQWaeopcyxsijhdqwly", strict=True))
ARMENIAN = dict(zip("ՍՏՕոսօցհղ", "USOnuoghn", strict=True))
LATIN_TWINS = dict(zip("ɑɡ", "ag", strict=True))
CHEROKEE = dict(zip("ᎪᏴᏟᎬᏀᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᏔᏃ", "ABCEGHJKLMPRSTVWZ", strict=True))
COPTIC = dict(zip("ⲀⲂⲤⲎⲔⲘⲚⲞⲢⲬⲟⲥ", "ABCHKMNOPXoc", strict=True))
LISU = dict(zip("ꓮꓐꓚꓓꓰꓝꓖꓧꓲꓙꓗꓡꓟꓠꓳꓑꓣꓢꓔꓴꓦꓪꓫꓬꓜ", "ABCDEFGHIJKLMNOPRSTUVWXYZ", strict=True))
#: Ideographs and hiragana, and the katakana of the same shape.
KANA = dict(zip("力二口工八夕卜へべぺ", "カニロエハタトヘベペ", strict=True))
IDEOGRAPH = {v: k for k, v in KANA.items() if k not in "へべぺ"}
HIRAGANA = {v: k for k, v in KANA.items() if k in "へべぺ"}
#: What follows an ideograph of these shapes after katakana; shapes that end a word of ideographs before katakana; counted units and numerals.
FOLLOWS = {"カ": "学士量点説", "ロ": "座径内頭述上", "エ": "業場事程具学芸作員賃", "ニ": "基次台社号階件名年月日人種重期", "ハ": "基次台社号階件名年月日人種重期", "タ": "方食刊日"}
ENDS_WORD = "カロ"
COUNTED, NUMERALS = "所月国年村条店町", "0123456789０１２３４５６７８９一二三四五六七八九十百千数何ニハ"
#: Radicals of the supplement block and the ideographs they display as.
RADICALS = dict(zip("⺟⻄⻑⻘⻙⻛⻜⻝⻢⻣⻤⻥⻦⻨⻩⻫⻭⻯⻲⻳⻁⻂⻅⻉⻋⻌⻐", "母西長青韦风飞食马骨鬼鱼鸟麦黄斉歯竜亀龟虎衤见贝车辶钅", strict=True))
SPACES = [0x00A0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000]
HYPHENS = [0x2010, 0x2011, 0x02D7, 0x2043, 0xFE63, 0xFF0D]
#: Besides the format characters (Cf): fillers, joiners and variation selectors that show nothing.
UNSEEN = [0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, *range(0x180B, 0x1810), 0x3164, 0xFFA0, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)]
LIGATURES = [*range(0xFB00, 0xFB07), *range(0xFB13, 0xFB18), 0x0132, 0x0133, 0x01C7, 0x01C8, 0x01C9, 0x01CA, 0x01CB, 0x01CC]


def _forms() -> dict[int, str | None]:
    """Character by character: what stands for it before accents are put together. Closed: what stands for a character stands for itself."""
    out: dict[int, str | None] = {}
    for cp in [*range(0xFF01, 0xFFEF), *range(0xFE50, 0xFE6C), *range(0x2F00, 0x2FD6), *LIGATURES]:
        c = chr(cp)
        if ud.name(c, ""):
            out[cp] = ud.normalize("NFKC", c)
    for cp in (0xFF9E, 0xFF9F):
        out[cp] = "゙" if cp == 0xFF9E else "゚"
    out |= dict.fromkeys(SPACES, " ") | dict.fromkeys(HYPHENS, "-")
    out |= {ord(k): v for k, v in RADICALS.items()}
    out |= dict.fromkeys(UNSEEN)
    for cp in range(0x110000):
        if ud.category(chr(cp)) == "Cf":
            out[cp] = None
    while any(ord(c) in out for v in out.values() for c in v or ""):
        out = {k: v and "".join(out.get(ord(c), c) or "" for c in v) for k, v in out.items()}
    return out


FORMS = _forms()
TWINS = {"Grek": GREEK, "Cyrl": CYRILLIC, "Armn": ARMENIAN, "Cher": CHEROKEE, "Copt": COPTIC, "Lisu": LISU}
#: Latin letter -> the letter of the same shape, by script.
BACK = {s: {v: k for k, v in t.items()} for s, t in TWINS.items()}
#: Letter -> its Latin twin, and its script.
TO_LATIN = LATIN_TWINS | {k: v for t in TWINS.values() for k, v in t.items()}
BLOCKS = {"Grek": ((0x0370, 0x03FF),), "Cyrl": ((0x0400, 0x052F),), "Armn": ((0x0530, 0x058F),), "Cher": ((0x13A0, 0x13FF), (0xAB70, 0xABBF)), "Copt": ((0x2C80, 0x2CFF),), "Lisu": ((0xA4D0, 0xA4FF),)}
FOREIGN = re.compile("[ɑɡ" + "".join(f"{chr(a)}-{chr(z)}" for rs in BLOCKS.values() for a, z in rs) + "]")
TOKEN = re.compile(r"[^\W\d_](?:[^\W\d_]|[\u0300-\u036f])*")
ANY = frozenset({"Any"})
AMBIGUOUS = re.compile(f"[{''.join(KANA)}{''.join(KANA.values())}]+")


@lru_cache(maxsize=100_000)
def script_set(c: str) -> frozenset[str]:
    """Scripts that have this letter or one of its shape."""
    cp = ord(c)
    if c in LATIN_TWINS:
        return frozenset({"Latn"}) | {s for s, t in BACK.items() if LATIN_TWINS[c] in t}
    for s, ranges in BLOCKS.items():
        if any(a <= cp <= z for a, z in ranges):
            twin = TWINS[s].get(c)
            return frozenset({s}) if twin is None else frozenset({s, "Latn"} | {o for o, t in BACK.items() if twin in t})
    if c.isascii() or 0x00C0 <= cp <= 0x024F or 0x1E00 <= cp <= 0x1EFF:
        return frozenset({"Latn"} | {s for s, t in BACK.items() if c in t})
    return ANY


def resolved(token: str) -> frozenset[str]:
    """The scripts in which the whole token can be spelled by letters of its shapes; empty: none."""
    left: frozenset[str] | None = None
    for c in token:
        s = script_set(c)
        if s is not ANY and not ud.combining(c):
            left = s if left is None else left & s
    return ANY if left is None else left


def spelled(token: str, script: str) -> str:
    """The token in one script, as far as that has its letters."""
    latin = "".join(TO_LATIN.get(c, c) for c in token)
    return latin if script == "Latn" else "".join(BACK[script].get(c, c) for c in latin) if script in BACK else token


def letters(text: str) -> str:
    """A decomposed text with every token in its consistent script."""
    found = list(TOKEN.finditer(text))
    can = [resolved(m.group()) for m in found]
    sure = [next(iter(s)) if len(s) == 1 and s is not ANY else None for s in can]
    before: list[str | None] = []
    for s in sure:
        before.append(s or (before[-1] if before else None))
    after: list[str | None] = [None] * len(sure)
    for i in range(len(sure) - 1, -1, -1):
        after[i] = sure[i] or (after[i + 1] if i + 1 < len(sure) else None)
    out, at = [], 0
    for m, s, b, a in zip(found, can, before, after, strict=True):
        if s is ANY:
            continue
        # No script spells it all: letter by letter, so that equal looks still give equal forms.
        script = "Latn" if not s else next(iter(s)) if len(s) == 1 else b if b in s else a if a in s else "Latn" if "Latn" in s else min(s)
        out += [text[at : m.start()], spelled(m.group(), script)]
        at = m.end()
    return "".join(out) + text[at:]


def _beside(c: str) -> str:
    """The script that the character beside a run speaks for."""
    if "\u30a0" <= c <= "\u30ff" and c not in "\u30fbヶヵ" or c in "\u3099\u309a":
        return "Kata"
    if "\u3041" <= c <= "\u309f":
        return "Hira"
    return "Hani" if "\u3400" <= c <= "\u9fff" or c in "々〆" else ""


def _run(run: str, left: str, right: str) -> str:
    """A run of shapes that kana share with ideographs or with each other, in its consistent script."""
    shape = "".join(KANA.get(c, c) for c in run)
    b, a = _beside(left) if left else "", _beside(right) if right else ""
    last, before = shape[-1], shape[-2:-1] or left
    # The last of a run may belong to what follows: a counted unit, a word of ideographs, a particle.
    own = ""
    if last == "カ" and right and right in COUNTED and before and before in NUMERALS:
        own = "カ"
    elif right and right in FOLLOWS.get(last, "") and (b == "Kata" or len(shape) > 1):
        own = IDEOGRAPH[last]
    elif last == "ヘ" and a in ("Hani", "Hira") and before:
        own = "へ"
    if own:
        return (_run(shape[:-1], left, "") if shape[:-1] else "") + own
    if all(c in HIRAGANA for c in shape):
        return shape if a == "Kata" and b != "Hani" or b == "Kata" and (shape != "ヘ" or a == "Kata") else "".join(HIRAGANA[c] for c in shape)
    if any(c in HIRAGANA for c in shape) or b == "Kata":
        return shape  # in the first case only katakana spells it all
    if a == "Kata":
        ideographs = b == "Hani" and len(shape) == 1 and (last in ENDS_WORD or left in "第" + NUMERALS and last in "ニハ")
    elif a or b:
        ideographs = True
    else:
        ideographs = len(shape) == 1 and shape != "ト"
    return "".join(IDEOGRAPH[c] for c in shape) if ideographs else shape


def kana(text: str) -> str:
    return AMBIGUOUS.sub(lambda m: _run(m.group(), text[m.start() - 1 : m.start()], text[m.end() : m.end() + 1]), text)


def _ranges(points: list[int]) -> str:
    """A character class of code points."""
    out, start = [], 0
    for i, p in enumerate(points):
        if i + 1 == len(points) or points[i + 1] != p + 1:
            out.append(f"\\U{points[start]:08x}-\\U{p:08x}")
            start = i + 1
    return f"[{''.join(out)}]"


REPLACED = re.compile(_ranges(sorted(FORMS)))


def consistent(text: str | None) -> str | None:
    if text is None or text.isascii():
        return text.replace("\r\n", "\n") if text and "\r" in text else text
    t = ud.normalize("NFC", text.replace("\r\n", "\n") if "\r" in text else text)
    t = REPLACED.sub(lambda m: FORMS[ord(m.group())] or "", t)
    if FOREIGN.search(t):
        t = letters(ud.normalize("NFD", t))
    return ud.normalize("NFC", kana(ud.normalize("NFC", t)))


@F.pandas_udf(T.StringType())
def _consistent(s: pd.Series) -> pd.Series:
    return s.map(consistent, na_action="ignore").astype(object).where(s.notna(), None)


def consistent_form(c: Column) -> Column:
    return _consistent(c)


def forms(df: DataFrame, key: str, keys: list[str], text: str, field: str) -> DataFrame:
    """field, id, cls, form: of each row with `keys` and text, the digests of what it looks like among its keys and of what is stored."""
    named = F.col(key).isNotNull() & F.col(text).isNotNull()
    for k in keys:
        named = named & F.col(k).isNotNull()
    digest = lambda *c: F.unhex(F.md5(F.concat_ws("\x1f", *c)))
    rows = df.where(named).select(F.col(key).alias("id"), *[F.col(k).cast("string").alias(f"k_{i}") for i, k in enumerate(keys)], F.col(text).alias("t"))
    cls = digest(F.lit(field), *[f"k_{i}" for i in range(len(keys))], consistent_form(F.col("t")))
    return rows.select(F.lit(field).alias("field"), "id", cls.alias("cls"), digest("t").alias("form"))


def classes(rows: DataFrame) -> DataFrame:
    """forms() of several tables, once each, in classes of more than one stored form. Cut: several readers, one pass over the texts.

    A class with one form, however many rows it has, leaves by an aggregate before anything is joined.
    """
    m = cut(rows.distinct())
    mixed = m.groupBy("cls").agg(F.min("form").alias("a"), F.max("form").alias("b")).where("a <> b").select("cls")
    return cut(m.join(mixed, "cls", "left_semi"))


def pairs(members: DataFrame) -> DataFrame:
    """field, left_id, right_id: rows of one class that are stored differently.

    The pairing is done on distinct stored forms; rows come in only for forms that are paired.
    """
    f = members.select("cls", "form").distinct()
    two = f.withColumnRenamed("form", "fa").join(f.withColumnRenamed("form", "fb"), "cls").where("fa < fb")
    got = two.join(members.select("cls", F.col("form").alias("fa"), F.col("id").alias("a")), ["cls", "fa"])
    got = got.join(members.select("field", "cls", F.col("form").alias("fb"), F.col("id").alias("b")), ["cls", "fb"])
    return got.where("a <> b").select("field", F.least("a", "b").alias("left_id"), F.greatest("a", "b").alias("right_id")).distinct()


def links(members: DataFrame) -> DataFrame:
    """field, id, class, links: one row per member of a class, with the number of rows it is paired with. No pair is built."""
    per = members.groupBy("cls", "form").agg(F.countDistinct("id").alias("same"))
    whole = per.groupBy("cls").agg(F.sum("same").alias("every"))
    j = members.join(per, ["cls", "form"]).join(whole, "cls")
    return j.select("field", "id", F.lower(F.hex("cls")).alias("class"), (F.col("every") - F.col("same")).alias("links"))


def same_looking(df: DataFrame, key: str, keys: list[str], text: str, field: str) -> DataFrame:
    return pairs(classes(forms(df, key, keys, text, field)))
