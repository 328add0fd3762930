"""Surrogates for personal data, in native expressions only.

Entities are found by one pattern: e-mail and IPv4 addresses, payment cards,
phone and social security numbers, IBANs, access keys, passwords after a label,
and names after a title. Each distinct entity (e-mail addresses and names
without regard to case, numbers without regard to separators) gets one keyed
surrogate of its type and format: digits for digits, letters for letters of the
same case and script, separators, country code and title kept, card check digits
valid, addresses in range, given names of the title's gender. The same entity
gets the same surrogate in every document.

A person is a full name, without titles, middle initials and case; the given
name's gender comes from any mention with a gendered title. A surname alone after
a title is, within its document, the one full name there that has it and does
not have the other gender; with none or several it is a person of its own. Names
and surnames that a document has after a title are replaced there without one
too. Given names alone and inflected names are not found. A name has at most
``PARTS`` parts; of a longer row of capitalised words the first ones are taken.

Surrogates are checked: one that another entity got too, or that is itself an
entity of the corpus, is drawn again with the next attempt number, until all are
distinct. From attempt ``LONGER`` on each attempt adds a character (an address
becomes one of IPv6), so free values always exist, also where nothing can be
drawn anew (``------``) or a format has fewer values than entities. Only the
distinct entities take part in that; a document is touched only if it has one,
and moves once.

Defined results: a null text stays null; rows with equal id and text are treated
alike; nothing found leaves the text as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recoflow.llm.common import free_name, read, split_by_ids
from recoflow.session import materialize

KEY = "surrogates-1"       # a deployment passes its own secret
# Given names by script and gender, as surrogates.
NAMES = {
    ("latin", "f"): ["Anna", "Clara", "Elena", "Frieda", "Greta", "Helena", "Ida", "Julia", "Laura", "Maria", "Nora", "Paula", "Rosa", "Sofia", "Teresa", "Vera"],
    ("latin", "m"): ["Anton", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Jonas", "Leon", "Martin", "Oscar", "Paul", "Robert", "Simon", "Victor"],
    ("latin", "n"): ["Alex", "Ariel", "Chris", "Dana", "Eden", "Jamie", "Kim", "Lee", "Morgan", "Noa", "Quinn", "Robin", "Sam", "Sascha", "Taylor", "Toni"],
    ("cyrillic", "f"): ["Анна", "Вера", "Дарья", "Елена", "Зоя", "Ирина", "Лариса", "Мария", "Нина", "Ольга", "Полина", "Раиса", "Софья", "Тамара", "Ульяна", "Юлия"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Захар", "Иван", "Кирилл", "Лев", "Максим", "Олег", "Павел", "Роман", "Семён", "Юрий"],
    ("cyrillic", "n"): ["Саша", "Женя", "Валя", "Шура", "Слава", "Паша", "Лера", "Тоня", "Рита", "Ника", "Мира", "Лада", "Кира", "Ева", "Аля", "Юна"],
}
FEMALE = "Mrs|Ms|Miss|Mme|Madame|Frau|Señora|Sra|Signora|Г-жа"
MALE = "Mr|Monsieur|Herr|Señor|Sr|Signor|Г-н"
NEUTRAL = "Dr|Prof|Mx"
TITLE = rf"(?:{FEMALE}|{MALE}|{NEUTRAL})"
PARTICLES = "(?:de|da|do|dos|das|di|del|della|der|den|du|la|van|von|ter|ten|zu|zum|bin|ibn|af|av)"
WORD = rf"(?!{TITLE}\b)\p{{Lu}}[\p{{L}}\p{{M}}]*+(?:['’]\p{{Lu}}[\p{{L}}\p{{M}}]*+|-\p{{L}}[\p{{L}}\p{{M}}]*+)*+"
LOCAL, LABEL = "[A-Za-z0-9_%+-]", "[A-Za-z0-9-]"
TITLES = 8                 # titles before a name at most
PARTS = 16                 # parts of a name at most: the first of a longer row of capitalised words
# The kinds in the order they are tried, without groups that capture. Repeated groups are possessive
# or bounded, as others cost stack, and an e-mail address is tried once per run of its characters.
PATTERNS = {
    "email": rf"(?<!{LOCAL})(?<!{LOCAL}\.){LOCAL}++(?:\.{LOCAL}++)*+@{LABEL}++(?:\.{LABEL}++){{0,126}}\.[A-Za-z]{{2,}}",
    "secret": r"(?<=(?:password|passwd|secret|token|api_key)[=:])[^\s,;]{6,}",
    "access": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\d-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\d)|\+\d{8,15}(?!\d)",
    "name": rf"\b(?:{TITLE}\.? ){{1,{TITLES}}}+(?:(?:{WORD}|(?:\p{{Lu}}\.)++|{PARTICLES}) ){{0,{PARTS - 1}}}(?=\p{{Lu}}[\p{{L}}\p{{M}}'’]){WORD}",
}
ANY = "|".join(PATTERNS.values())
# What a character is drawn from, by its sort; the first that fits. Others, the separators, stay.
ALPHABETS = {
    "[0-9]": "0123456789",
    "[a-z]": "abcdefghijklmnopqrstuvwxyz",
    "[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "[а-яё]": "абвгдежзиклмнопрстуфхцчшщэюя",
    "[А-ЯЁ]": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЭЮЯ",
    r"(?=\p{IsGreek})\p{Lu}": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
    r"\p{IsGreek}": "αβγδεζηθικλμνξοπρστυφχψω",
    r"\p{IsHan}": "安白北本长成大东方高古光国海和华江金京开立林明木南平青山上石水天文西小新雪阳云中",
    r"\p{IsHiragana}": "あいうえおかきくけこさしすせそたちつてとなにぬねのはひふへほまみむめもやゆよらりるれろ",
    r"\p{IsKatakana}": "アイウエオカキクケコサシスセソタチツテトナニヌネノハヒフヘホマミムメモヤユヨラリルレロ",
    r"\p{IsHangul}": "가나다라마바사아자차카타파하고노도로모보소오조초코토포호구누두루무부수우주추쿠투푸후",
    r"\p{IsArabic}": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي",
    r"\p{IsHebrew}": "אבגדהוזחטיכלמנסעפצקרשת",
    r"\p{IsDevanagari}": "अआइईउऊएऐओऔकखगघचछजझटठडढतथदधनपफबभमयरलवशषसह",
    r"\p{IsThai}": "กขคงจฉชซญดตถทธนบปผพฟมยรลวสหอ",
    r"\p{Lu}": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    r"[\p{L}\p{M}]": "abcdefghijklmnopqrstuvwxyz",
    r"\p{N}": "0123456789",
}
SYMBOL, SYMBOLS = r"[!#$%&*?@^~+=\\]|(?![\x00-\x7f])\p{S}", "!#$%&*?@^~+="      # drawn in secrets only
LONGER = 6                 # attempts before surrogates become longer


def kind_of(raw):
    out = F.lit("name")
    for name, pattern in reversed([p for p in PATTERNS.items() if p[0] not in ("name", "secret")]):
        out = F.when(raw.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(out)
    titled = raw.rlike(f"^(?:{PATTERNS['name']})$")
    plain = raw.rlike("^(?:" + "|".join(p for k, p in PATTERNS.items() if k not in ("name", "secret")) + ")$")
    return F.when(titled | plain, out).otherwise(F.lit("secret"))


def canonical(kind, raw):
    """What two mentions of one entity have in common."""
    return (F.when(kind == "email", F.lower(raw))
            .when(kind.isin("card", "iban"), F.regexp_replace(raw, "[ -]", ""))
            .when(kind == "phone", F.regexp_replace(raw, r"[^\d+]", ""))
            .when(kind == "name", F.lower(plain(raw)))
            .otherwise(raw))


def gender(raw):
    return (F.when(raw.rlike(rf"^(?:{TITLE}\.? )*(?:{FEMALE})\b"), F.lit("f"))
            .when(raw.rlike(rf"^(?:{TITLE}\.? )*(?:{MALE})\b"), F.lit("m")).otherwise(F.lit("n")))


def untitled(raw):
    return F.regexp_replace(raw, rf"^(?:{TITLE}\.? )+", "")


def plain(raw):
    """A name without titles and middle initials."""
    return F.regexp_replace(untitled(raw), r"(?<= )(?:(?:\p{Lu}\.)+|\p{Lu}) ", "")


def surname(name):
    """The last word of a plain name, with the particles before it."""
    return F.regexp_extract(name, rf"(?i)(?:^|(?<= ))((?:{PARTICLES} )*[^ ]+?(?: (?:jr|ii|iii|iv))?)$", 1)


def known_names(found):
    """Names and surnames after titles among the mentions ``found``, longest first."""
    named = F.filter(found, lambda x: x.rlike(rf"^{TITLE}\.? "))
    names = F.array_distinct(F.flatten(F.transform(named, lambda x: F.array(untitled(x), plain(x), surname(plain(x))))))
    sized = F.transform(F.filter(names, lambda x: F.length(x) > 1), lambda x: F.struct(-F.length(x), x.alias("name")))
    return F.transform(F.array_sort(sized), lambda x: x["name"])


def with_names(known):
    """The pattern of a document that has the ``known`` names."""
    quoted = F.array_join(F.transform(known, lambda x: F.concat(F.lit("\\Q"), x, F.lit("\\E"))), "|")
    more = F.concat(F.lit(r"|(?<![\p{L}\p{M}\p{N}])(?:"), quoted, F.lit(r")(?![\p{L}\p{M}\p{N}])"))
    return F.concat(F.lit(ANY), F.when(F.size(known) > 0, more).otherwise(F.lit("")))


def persons(names: DataFrame) -> DataFrame:
    """Name mentions (_id, _hash, raw, ident) with the identity resolved in their document and ``sex``.

    The identity of a full name begins with ``:``, that of a surname of its own with its gender.
    """
    names = names.withColumn("sex", gender(F.col("raw"))).withColumn("_last", surname(F.col("ident")))
    whole, name, sex = F.col("_last") != F.col("ident"), F.col("ident"), F.col("sex")
    # full names have one gender in the corpus, none if their titles disagree
    known = names.filter(whole & (sex != "n")).groupBy("ident").agg(F.when(F.min("sex") == F.max("sex"), F.min("sex")).alias("_sex"))
    names = names.join(known, "ident", "left").withColumn("sex", F.when(whole, F.coalesce("_sex", F.lit("n"))).otherwise(sex)).drop("_sex")
    near = Window.partitionBy("_id", "_hash", "_last")
    names = names.withColumn("_full", F.collect_set(F.when(whole, F.struct(name.alias("name"), sex.alias("sex")))).over(near))
    names = names.withColumn("_sexes", F.collect_set(F.when(~whole & (sex != "n"), sex)).over(near))
    of = lambda keep: F.array_distinct(F.transform(F.filter("_full", keep), lambda x: x["name"]))
    one = lambda found: F.when(F.size(found) == 1, F.get(found, F.lit(0)))
    every, same = of(lambda x: F.lit(True)), of(lambda x: x["sex"] == F.col("sex"))
    open_ = F.array_except(every, of(lambda x: ~x["sex"].isin("n") & (x["sex"] != F.col("sex"))))
    linked = F.when(sex == "n", one(every)).when(F.size(same) > 0, one(same)).otherwise(one(open_))
    own = F.when(sex != "n", sex).otherwise(F.coalesce(one(F.col("_sexes")), F.lit("n")))
    ident = F.when(whole, F.concat(F.lit(":"), name)).otherwise(F.coalesce(F.concat(F.lit(":"), linked), F.concat_ws(":", own, name)))
    return names.withColumn("ident", ident).drop("_last", "_full", "_sexes")


def _drawn(key, kind, value, attempt, block):
    return F.sha2(F.concat_ws("\u0000", key, kind, value, attempt.cast("string"), F.lit(str(block))), 512)


def _letters(stream, text, fixed, symbols):
    """``text`` with each character but separators drawn anew, of the same sort; the first ``fixed`` characters stay.

    ``stream`` is hexadecimal and reused for long texts with the place mixed in;
    ``symbols`` says whether these are drawn too.
    """
    span = F.length(stream) - 3

    def one(c, i):
        sort = F.when(i < fixed, None)
        for pattern, letters in ALPHABETS.items():
            sort = sort.when(c.rlike(pattern), F.lit(letters))
        sort = sort.when(symbols & c.rlike(SYMBOL), F.lit(SYMBOLS))
        seed = F.conv(F.substr(stream, F.pmod(i * 3, span) + 1, F.lit(3)), 16, 10).cast("int") + i
        return F.coalesce(F.substr(sort, F.pmod(seed, F.length(sort)) + 1, F.lit(1)), c)
    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits):
    """The digits with a last one that makes the card valid."""
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    total = F.aggregate(F.transform(F.reverse(F.split(body, "")), lambda c, i: F.when(
        i % 2 == 0, F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))).otherwise(c.cast("int"))),
        F.lit(0), lambda a, b: a + b)
    return F.concat(body, F.pmod(-total, F.lit(10)).cast("string"))


def surrogate(key, kind, value, attempt):
    """The surrogate of a canonical entity, itself in canonical form."""
    stream = F.concat(*[_drawn(key, kind, value, attempt, b) for b in range(2)])
    number = lambda at, n: F.pmod(F.conv(F.substr(stream, F.lit(at), F.lit(6)), 16, 10).cast("long"), F.lit(n))
    # characters added by late attempts, from a block of their own
    more = F.greatest(attempt - (LONGER - 1), F.lit(0))
    added = F.substr(_drawn(key, kind, value, attempt, 2), F.lit(1), more)
    digits, small = F.translate(added, "abcdef", "012345"), F.translate(added, "0123456789", "ghijklmnop")
    octets = F.concat_ws(".", *[(number(1 + 6 * i, 254) + 1).cast("string") for i in range(4)])
    wide = F.concat(F.lit("fd"), F.substr(stream, F.lit(1), F.lit(2)), *[F.concat(F.lit(":"), F.substr(stream, F.lit(3 + 4 * i), F.lit(4))) for i in range(7)])
    user, top = F.substring_index(value, "@", 1), F.substring_index(value, ".", -1)
    sex, rest = F.substring_index(value, ":", 1), F.substr(value, F.lit(3))
    first = F.substring_index(rest, " ", 1)
    listed = (surname(rest) != rest) & ~first.endswith(".")     # else a surname alone or an initial: letters only
    # one call for all kinds keeps the plan small
    text = (F.when(kind == "email", F.substr(value, F.lit(1), F.length(value) - F.length(top)))
            .when(kind == "name", F.when(listed, F.substr(rest, F.length(first) + 2)).otherwise(rest)).otherwise(value))
    fixed = (F.when(kind == "card", 1).when(kind == "iban", 2).when(kind == "access", 4)
             .when((kind == "phone") & value.startswith("+"), 2).otherwise(0))
    letters = _letters(stream, text, fixed, ~kind.isin(*[k for k in PATTERNS if k != "secret"]))
    mail = F.concat(F.substr(letters, F.lit(1), F.length(user)), small, F.substr(letters, F.length(user) + 1, F.length(letters)), top)
    script = F.when(rest.rlike(r"[Ѐ-ӿ]"), F.lit("cyrillic")).otherwise(F.lit("latin"))
    given = F.lit(None).cast("string")
    for (name_script, name_sex), names in NAMES.items():
        given = F.when((script == name_script) & (sex == name_sex), F.get(F.array(*[F.lit(n) for n in names]), number(1, len(names)).cast("int"))).otherwise(given)
    person = F.concat(sex, F.lit(":"), F.lower(F.concat_ws(" ", F.when(listed, given), letters)))
    return (F.when(kind == "email", mail).when(kind == "ip", F.when(attempt < LONGER, octets).otherwise(wide))
            .when(kind == "card", _luhn(F.concat(letters, digits)))
            .when(kind.isin("phone", "iban", "ssn"), F.concat(letters, digits))
            .when(kind == "access", F.concat(letters, F.upper(small)))
            .when(kind == "name", F.concat(person, small)).otherwise(F.concat(letters, small)))


def shaped(kind, raw, value):
    """``value`` with the separators, title and capitals of the mention ``raw``."""
    # the n-th character that is no separator takes the n-th of the surrogate, the last one also what is longer
    spread = F.aggregate(
        F.split(raw, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda a, c: F.when(c.rlike("[0-9A-Z+]"), F.struct(F.concat(a["out"], F.substr(value, a["at"], F.lit(1))).alias("out"), (a["at"] + 1).alias("at")))
        .otherwise(F.struct(F.concat(a["out"], c).alias("out"), a["at"].alias("at"))), lambda a: F.concat(a["out"], F.substr(value, a["at"], F.length(value))))
    # a surname takes the last words, and capitals lie where the mention has them
    title, name, drawn = F.regexp_extract(raw, rf"^(?:{TITLE}\.? )+", 0), plain(raw), F.split(F.substr(value, F.lit(3)), " ")
    capitals = lambda text, like: F.array_join(F.transform(F.split(text, ""), lambda c, i: F.when(
        F.get(F.split(like, ""), i).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)), "")
    size, last = F.size(F.split(name, " ")), lambda n: F.array_join(F.slice(drawn, F.greatest(-n, -F.size(drawn)), n), " ")
    alone = surname(F.lower(name)) == F.lower(name)
    full = F.concat(F.initcap(F.get(drawn, F.lit(0))), F.lit(" "), capitals(last(F.greatest(F.size(drawn) - 1, F.lit(1))), F.substr(name, F.length(F.substring_index(name, " ", 1)) + 2)))
    return (F.when(kind.isin("card", "phone", "iban"), spread)
            .when(kind == "name", F.concat(title, F.when(alone, capitals(last(size), name)).otherwise(full))).otherwise(value))


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, value, surrogate) of distinct ``entities`` (kind, value), all surrogates distinct and none an entity."""
    real = materialize(entities.select("kind", "value").distinct(), "entities")
    todo, done, attempt = real, None, 0
    # names are told apart without their gender
    shown = lambda c: F.when(F.col("kind") == "name", F.substr(F.col(c), F.lit(3))).otherwise(F.col(c)).alias("shown")
    while True:
        drawn = todo.withColumn("surrogate", surrogate(F.lit(key), F.col("kind"), F.col("value"), F.lit(attempt)))
        drawn = materialize(drawn.select("*", shown("surrogate")), "drawn")
        taken = real.select("kind", shown("value"))
        if done is not None:
            taken = taken.unionByName(done.select("kind", shown("surrogate")))
        first = drawn.groupBy("kind", "shown").agg(F.min("value").alias("winner"))
        first = first.join(taken.distinct(), ["kind", "shown"], "left_anti")
        drawn = materialize(drawn.join(first, ["kind", "shown"], "left"), "drawn")
        won = F.coalesce(F.col("winner") == F.col("value"), F.lit(False))
        good = drawn.filter(won).select("kind", "value", "surrogate")
        done = materialize(good if done is None else done.unionByName(good), "assigned")
        todo = drawn.filter(~won).select("kind", "value")
        attempt += 1
        if todo.isEmpty():
            return done


def replace(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text``, and a column ``n_entities``."""
    found = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"), "text",
                        F.regexp_extract_all("text", F.lit(ANY), F.lit(0)).alias("_raw")).filter(F.size("_raw") > 0)
    found = found.withColumn("_known", known_names(F.col("_raw")))
    again = F.regexp_extract_all("text", with_names(F.col("_known")), F.lit(0))
    found = found.select("_id", "_hash", "_known", F.when(F.size("_known") > 0, again).otherwise(F.col("_raw")).alias("_raw"))
    found = materialize(found.distinct(), "mentions")
    each = found.select("_id", "_hash", "_known", F.posexplode("_raw").alias("_at", "raw"))
    each = each.withColumn("kind", F.when(F.array_contains("_known", F.col("raw")), F.lit("name")).otherwise(kind_of(F.col("raw"))))
    each = each.withColumn("ident", canonical(F.col("kind"), F.col("raw"))).withColumn("_known", F.when(F.col("_at") == 0, F.col("_known")))
    each = materialize(each, "mentions")
    each = each.filter("kind <> 'name'").withColumn("sex", F.lit("n")).unionByName(persons(each.filter("kind = 'name'")))
    each = materialize(each, "persons")
    f, m = F.max(F.col("sex") == "f"), F.max(F.col("sex") == "m")
    sex = F.when(f & ~m, F.lit("f")).when(m & ~f, F.lit("m")).otherwise(F.lit("n"))
    entities = each.groupBy("kind", "ident").agg(sex.alias("sex"))
    entities = materialize(entities.select("kind", "ident", F.when(
        (F.col("kind") == "name") & F.col("ident").startswith(":"), F.concat("sex", "ident")).otherwise(F.col("ident")).alias("value")), "persons")
    assigned = entities.join(assign(entities, key), ["kind", "value"]).select("kind", "ident", "surrogate")
    named = each.join(assigned, ["kind", "ident"])
    named = named.select("_id", "_hash", "_at", "_known", shaped(F.col("kind"), F.col("raw"), F.col("surrogate")).alias("new"))
    new = named.groupBy("_id", "_hash").agg(F.array_sort(F.collect_list(F.struct("_at", "new"))).alias("_new"),
                                            F.first("_known", ignorenulls=True).alias("_known"))
    new = materialize(new.withColumn("_new", F.transform("_new", lambda x: x["new"])), "replacements")
    hashed, number = free_name(docs, "text_hash"), free_name(docs, "n_entities")
    mine = [free_name(docs, n) for n in ("_id", "_hash", "_new", "_known")]
    new = new.select("_id", "_hash", "_new", "_known").toDF(*mine)
    of_id, of_hash, put, known = mine
    maybe, same = split_by_ids(docs.withColumn(hashed, F.xxhash64("text")), hashed, new.select(of_hash))
    between = F.split("text", with_names(F.col(known)), -1)
    text = F.array_join(F.zip_with(between, put, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = maybe.join(new, F.col("doc_id").eqNullSafe(F.col(of_id)) & (F.col(hashed) == F.col(of_hash)), "left")
    changed = changed.select(
        *[F.when(F.col(put).isNull(), F.col("text")).otherwise(text).alias("text") if c == "text" else F.col(c) for c in docs.columns],
        F.coalesce(F.size(put), F.lit(0)).cast("long").alias(number))
    return changed.unionByName(same.select(*docs.columns, F.lit(0).cast("long").alias(number)))


def op10_surrogates(spark, sf_dir: str) -> DataFrame:
    return replace(read(spark, sf_dir, "documents").select("doc_id", "text"))
