"""Replacement of personal data by keyed surrogates, in DataFrame operations only.

One pattern finds entities in whole texts: mail addresses, phone numbers, network addresses,
payment cards, social security and bank account numbers, access keys, and names after a title.
Each distinct entity gets a surrogate of its own type: characters are replaced class by class
(digit by digit, letter by letter of the same case), cards keep a valid check digit, names come
from lists by gender and script. A surrogate is a keyed hash of the entity, so every mention in
the corpus gets the same one. The entity is what stays when a spelling is set aside: a card,
phone, social security or account number without its separators, a mail or network address in
lower case; a number's surrogate is written with the separators of the mention. A name that a title shows
is replaced in the rest of its text too, title or not. Proposals that meet another proposal, an earlier surrogate or any
real entity are drawn anew in further rounds, until all are distinct.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored

# Titles that tell a gender, and lists of names by gender and script.
TITLES_F = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа", "г-жа")
TITLES_M = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "господин", "г-н")
NAMES = {
    "GIVEN_F": "Anna Maria Laura Julia Clara Emma Sophie Elena Nora Ida Alice Marta Irene Lucia Helen Ruth Paula Sara Vera Olivia".split(),
    "GIVEN_M": "Paul Martin Peter Daniel Lucas Simon Oscar Victor Hugo Felix Anton David Jonas Robert Leon Samuel Arthur Bruno Emil Max".split(),
    "SURNAME": "Keller Moreau Garcia Novak Berger Lambert Costa Fischer Marin Walker Romero Becker Dubois Weber Santos Turner Vidal Hansen Rossi Clark".split(),
    "GIVEN_F_CYR": "Анна Мария Елена Ольга Ирина Вера Нина Дарья Софья Татьяна".split(),
    "GIVEN_M_CYR": "Иван Пётр Павел Борис Антон Виктор Олег Максим Андрей Сергей".split(),
    "SURNAME_F_CYR": "Орлова Соколова Лебедева Зайцева Белова Громова Титова Комарова Фролова Миронова".split(),
    "SURNAME_M_CYR": "Орлов Соколов Лебедев Зайцев Белов Громов Титов Комаров Фролов Миронов".split(),
}

_TITLE = "(?:" + "|".join((*TITLES_F, *TITLES_M)) + r")\.?"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Entity types in order of preference, with the pattern of each.
PATTERNS = {
    "EMAIL": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "SECRET": r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{20,}|[0-9a-f]{32,128})(?![A-Za-z0-9])",
    "IP6": r"(?<![0-9A-Za-z:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])",
    "IP": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "CARD": r"(?<![\d+])(?:[3-6]\d{3}(?:[ -]\d{4}){3}|[3-6]\d{12,18})(?!\d)",
    "SSN": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "PHONE": r"(?<![\d+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[-. ]\d{4}|\d{3}[-. ]\d{3}[-. ]\d{4})(?!\d)",
    "IBAN": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "NAME": rf"(?<!\p{{L}}){_TITLE} \p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+)?",
}
ANY = "|".join(PATTERNS.values())
#: Of a phone number the country code stays: by the numbering plan one digit for 1 and 7, two
#: for those listed, three for the others.
_KEPT = {
    "SECRET": r"^(?:AKIA|gh[pousr]_|sk-)",
    "PHONE": r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})",
    "IBAN": r"^[A-Z]{2}\d{2}",
    "CARD": r"^\d",
}
_SPACED, _LOWERED = ("CARD", "SSN", "PHONE", "IBAN"), ("EMAIL", "IP6")
_SIGN = "[^A-Za-z0-9+]"


def _type(match: Column) -> Column:
    whole = {t: rf"\A(?:{p})\z" for t, p in PATTERNS.items()}
    return reduce(lambda c, t: c.when(match.rlike(whole[t]), F.lit(t)), list(whole)[1:], F.when(match.rlike(whole["EMAIL"]), F.lit("EMAIL")))


def _entities(match: Column) -> Column:
    """A match's entities in order: (lead, kind, value, shape), the value without what belongs
    to its spelling, the shape as written. A name gives one for the given name,
    if there is one, and one for the surname, so that both stay the same in other mentions. A
    number whose check digit is wrong is no card: it is all lead, with a null kind."""
    words = F.split(match, " ")
    title, female = F.rtrim(words[0], F.lit(".")), F.rtrim(words[0], F.lit(".")).isin(*TITLES_F)
    cyrillic = match.rlike(r"\p{IsCyrillic}")
    sex = F.when(female, F.lit("F")).otherwise(F.lit("M"))
    given = F.concat(F.lit("GIVEN_"), sex, F.when(cyrillic, F.lit("_CYR")).otherwise(F.lit("")))
    surname = F.when(cyrillic, F.concat(F.lit("SURNAME_"), sex, F.lit("_CYR"))).otherwise(F.lit("SURNAME"))
    lead = F.concat(words[0], F.lit(" "))

    def one(a, kind, value, shape=None):
        return F.struct(a.alias("lead"), kind.alias("kind"), value.alias("value"), (value if shape is None else shape).alias("shape"))

    kind = _type(match)
    value = F.when(kind.isin(*_LOWERED), F.lower(match)).when(kind.isin(*_SPACED), F.regexp_replace(match, _SIGN, "")).otherwise(match)
    plain = one(F.lit(""), kind, value, match)
    named = F.when(
        F.size(words) > 2, F.array(one(lead, given, F.get(words, F.lit(1))), one(F.lit(" "), surname, F.get(words, F.lit(2))))
    ).otherwise(F.array(one(lead, surname, F.get(words, F.lit(1)))))
    nothing = F.lit(None).cast("string")
    no_card = (kind == "CARD") & (luhn(F.regexp_replace(match, r"\D", "")) != 0)
    return F.when(kind == "NAME", named).when(no_card, F.array(one(match, nothing, nothing))).otherwise(F.array(plain))


# ------------------------------------------------------------------ surrogates
def _draw(key: str, kind: Column, value: Column, turn: int, i: Column) -> Column:
    """A number from 0 to 65535 for place ``i``, keyed by the secret, the entity and the round."""
    told = F.concat_ws("\x1f", F.lit(key), kind, value, F.lit(turn).cast("string"), i.cast("string"))
    return F.conv(F.substring(F.sha2(F.concat(F.lit(key), F.sha2(told, 256)), 256), 1, 4), 16, 10).cast("int")


def _letters(key, kind, value, turn) -> Column:
    """Character by character within its class, behind the part that the type keeps. From the
    twelfth round on, when a format is nearly used up, it grows by one character every four."""
    head = reduce(lambda c, t: c.when(kind == t, F.regexp_extract(value, _KEPT[t], 0)), list(_KEPT)[1:], F.when(kind == "SECRET", F.regexp_extract(value, _KEPT["SECRET"], 0)))
    head = F.coalesce(head, F.when(kind == "EMAIL", F.lit("")), F.lit(""))
    tail = F.when(kind == "EMAIL", F.regexp_extract(value, r"\.[^.]*$", 0)).otherwise(F.lit(""))
    body = F.substr(value, F.length(head) + 1, F.length(value) - F.length(head) - F.length(tail))
    body = F.concat(*[F.lit("0")] * max(0, (turn - 8) // 4), body) if turn >= 12 else body
    hexed = value.rlike(r"\A[0-9a-f]{32,}\z") | (kind == "IP6")

    def other(c, i):
        n = _draw(key, kind, value, turn, i)
        pick = lambda first, size: F.chr(F.pmod(n, size) + F.lit(ord(first)))
        return (
            F.when(c.rlike("[0-9]"), pick("0", F.lit(10)))
            .when(c.rlike("[a-z]"), pick("a", F.when(hexed, F.lit(6)).otherwise(F.lit(26))))
            .when(c.rlike("[A-Z]"), pick("A", F.lit(26)))
            .otherwise(c)
        )

    return F.concat(head, F.array_join(F.transform(F.split(body, ""), other), ""), tail)


def luhn(digits: Column) -> Column:
    """The Luhn sum of a text of digits, modulo 10."""
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    each = F.transform(
        F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int"))
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10


def _card(text: Column) -> Column:
    """The last digit set so that the check digit is valid."""
    front = F.substr(text, F.lit(1), F.length(text) - 1)
    off = luhn(F.concat(F.regexp_replace(front, r"\D", ""), F.lit("0")))
    return F.concat(front, F.pmod(F.lit(10) - off, F.lit(10)).cast("string"))


def _iban(text: Column) -> Column:
    """The two digits behind the country set so that the number leaves 1 when divided by 97."""
    country, rest = F.substring(text, 1, 2), F.substring(text, 5, 64)
    step = lambda a, c: F.when(c.rlike("[0-9]"), a * 10 + F.ascii(c) - 48).otherwise(a * 100 + F.ascii(c) - 55) % 97
    left = F.aggregate(F.split(F.concat(rest, country, F.lit("00")), ""), F.lit(0), step)
    return F.concat(country, F.lpad((F.lit(98) - left).cast("string"), 2, "0"), rest)


def _placed(kind: Column, shape: Column, surrogate: Column) -> Column:
    """A surrogate in the spelling of a mention: with its separators. Surrogates of addresses
    are in lower case whatever the mention."""
    at = lambda i: F.length(F.regexp_replace(F.substr(shape, F.lit(1), i + 1), _SIGN, ""))
    spaced = F.transform(F.split(shape, ""), lambda c, i: F.when(c.rlike(_SIGN), c).otherwise(F.substr(surrogate, at(i), F.lit(1))))
    spaced = F.concat(F.array_join(spaced, ""), F.substr(surrogate, F.length(F.regexp_replace(shape, _SIGN, "")) + 1, F.lit(64)))
    return F.when(kind.isin(*_SPACED), spaced).otherwise(surrogate)


def _name(key, kind, value, turn) -> Column:
    """A name of the kind's list; from the third round on several, joined by hyphens."""
    out = None
    for k, names in NAMES.items():
        pool = F.array(*map(F.lit, names))
        parts = [F.get(pool, F.pmod(_draw(key, kind, value, turn, F.lit(i)), F.lit(len(names)))) for i in range(1 + turn // 3)]
        drawn = F.concat_ws("-", *parts)
        out = F.when(kind == k, drawn) if out is None else out.when(kind == k, drawn)
    return out


def propose(key: str, kind: Column, value: Column, turn: int) -> Column:
    """The surrogate that an entity proposes in a round."""
    octet = lambda c, i: (F.pmod(_draw(key, kind, value, turn, i), F.lit(254)) + 1).cast("string")
    ip = F.array_join(F.transform(F.split(value, r"\."), octet), ".")
    text = _letters(key, kind, value, turn)
    return F.when(kind == "IP", ip).when(kind == "CARD", _card(text)).when(kind == "IBAN", _iban(text)).when(kind.isin(*NAMES), _name(key, kind, value, turn)).otherwise(text)


def assign(entities: DataFrame, key: str, most_turns: int = 200) -> DataFrame:
    """(kind, value, surrogate) for all distinct entities: no two of a kind share a
    surrogate, and none is a real entity. Each round is written to the shared folder."""
    real = stored(entities.select("kind", "value").distinct(), "pii-entities")
    todo, done = real, None
    for turn in range(most_turns):
        offers = todo.withColumn("surrogate", propose(key, F.col("kind"), F.col("value"), turn))
        won = offers.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        won = won.join(real.select("kind", F.col("value").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if done is not None:
            won = won.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = stored(won.select("kind", "value", "surrogate"), "pii-round")
        done = won if done is None else done.unionAll(won)
        todo = stored(todo.join(won.select("kind", "value"), ["kind", "value"], "left_anti"), "pii-left")
        if todo.isEmpty():
            return done
    raise RuntimeError("no distinct surrogates were found")


#: Where the caller gives no key: a setting of the session, so that no secret stands in code.
KEY_CONF = "spark.strata.pii.key"


def _bound(part: Column, told: Column) -> Column:
    """The text between matches with the names that titles show in the same text replaced:
    first by marks, then the marks by surrogates, so that no surrogate is replaced again."""
    names = F.filter(told, lambda m: m["kind"].isin(*NAMES))
    find = lambda m: F.concat(F.lit(r"(?<!\p{L})"), m["shape"], F.lit(r"(?!\p{L})"))
    mark = lambda m: F.concat(F.lit("\ue000"), m["pos"].cast("string"), F.lit("."), m["sub"].cast("string"), F.lit("\ue001"))
    marked = F.aggregate(names, part, lambda t, m: F.regexp_replace(t, find(m), mark(m)))
    filled = F.aggregate(names, marked, lambda t, m: F.replace(t, mark(m), m["surrogate"]))
    return F.when(F.size(names) > 0, filled).otherwise(part)


def replace(df: DataFrame, text_col: str = "text", key: str | None = None, count_col: str | None = None) -> DataFrame:
    """``df`` with the entities of ``text_col`` replaced; with ``count_col``, also a column
    with the number of matches replaced.

    Surrogates are keyed by ``key``, else by the session's ``KEY_CONF``, else by a fixed text that
    keeps no secret. Null and empty texts, and texts without entities, stay as they are and are
    not shuffled. The replacement depends on the text alone, so equal texts stay equal, whatever
    their ids; it is worked out once for each distinct text. Other columns pass through. An
    empty table gives no rows. Texts are searched once: matches are stored beside the rows, and
    only texts with matches are cut at them.
    """
    key = key or df.sparkSession.conf.get(KEY_CONF, None) or "surrogate-key-1"
    row = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), df[text_col].alias("text"))
    row = stored(row.withColumn("marks", F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).select("row", "marks"), "pii-marked")
    text, found = F.col("row")[text_col], F.coalesce(F.size("marks") > 0, F.lit(False))
    hit = row.filter(found).withColumn("key", F.sha2(text.cast("binary"), 256))
    each = hit.select("key", "marks").dropDuplicates(["key"]).select("key", F.posexplode("marks").alias("pos", "mark"))
    each = stored(each.select("key", "pos", F.posexplode(_entities(F.col("mark"))).alias("sub", "e")).select("key", "pos", "sub", "e.*"), "pii-mentions")
    table = assign(each.filter("kind is not null"), key)
    told = each.join(table, ["kind", "value"], "left").withColumn("surrogate", _placed(F.col("kind"), F.col("shape"), F.col("surrogate")))
    told = told.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("pos", "sub", "lead", "surrogate", "kind", "shape"))).alias("told"))  # of one text
    joined = hit.join(told, "key").withColumn("parts", F.transform(F.split(text, ANY, -1), lambda p: _bound(p, F.col("told"))))
    put = lambda m: F.concat(F.when(m["sub"] == 0, F.get(F.col("parts"), m["pos"])).otherwise(F.lit("")), m["lead"], F.coalesce(m["surrogate"], F.lit("")))
    new = F.concat(F.array_join(F.transform("told", put), ""), F.element_at("parts", -1))
    n = F.size(F.filter("told", lambda m: (m["sub"] == 0) & m["surrogate"].isNotNull()))
    extra = [count_col] if count_col else []
    cols = lambda t, k: [(t if c == text_col else F.col("row")[c]).alias(c) for c in df.columns] + [k.cast("int").alias(x) for x in extra]
    return row.filter(~found).select(*cols(text, F.lit(0))).unionAll(joined.select(*cols(new, n)))
