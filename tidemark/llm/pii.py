"""Personal data replaced by surrogates, in DataFrame functions only.

Detected entities: e-mail addresses, IPv4 and IPv6 addresses, phone numbers, card numbers, IBANs, social-security
numbers, secrets (hexadecimal, with a vendor's prefix, or assigned to a word such as token), and names of people
(by title or by a known first name; Latin, Greek, Cyrillic, and Chinese before a form of address). The words of a
name are replaced wherever else they stand in its text.
A surrogate is a function of the entity and a key alone, so an entity has one surrogate wherever it occurs, and it
is a bijection for every kind but e-mail (96 bits of a digest), so different entities keep different surrogates
over any number of texts. Digits and letters are exchanged by keyed Feistel networks within their class, which keeps
length, case, script and separators; check digits stay valid or invalid; a known first name becomes another
one of its gender and script.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spare

#: First names by script and gender, Chinese surnames, titles, prefixes of secrets, words that secrets are assigned to.
FIRST = {
    ("latin", "f"): "Anna Maria Emma Laura Sofia Julia Clara Elena Alice Sarah Mary Linda Susan Karen Lisa Nancy Helen Ruth Carol Emily Julie Camille Carmen Lucia Greta Jennifer Jessica Elizabeth Patricia Barbara Margaret Olivia Priya Fatima Aisha".split(),
    ("latin", "m"): "John James Robert Michael William David Richard Joseph Thomas Charles Daniel Paul Mark George Peter Martin Hans Jean Pierre Luis Carlos Jorge Stefan Walter Henry Christopher Matthew Andrew Steven Kevin Brian Ahmed Mohammed Rajesh Kenji".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Екатерина Юлия".split(),
    ("cyrillic", "m"): "Иван Александр Сергей Дмитрий Андрей Алексей Михаил Николай Владимир Павел".split(),
}
HAN_SURNAMES = "王李张刘陈杨黄赵吴周"
TITLES = "Mrs Ms Miss Mx Mr Dr Prof Professor Frau Herr Madame Mme Monsieur Señora Señor Sra Sr Signora Signor г-жа г-н".split()
PREFIXES = r"AKIA|ASIA|AIza|gh[pousr]_|xox[abprs]-|sk-|[spr]k_live_"
ASSIGNED = "token|password|passwd|secret|api[_\\-]?key"

#: Letters that change places with each other.
LETTERS = [
    "aeiou", "bcdfghjklmnpqrstvwxyz", "àáâãäåāăąæèéêëēėęěìíîïīįòóôõöøōőœùúûüūůűųýÿ", "çćčďđðğłńñňřśşšťţþźżž",
    "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αεηιουω", "άέήίόύώ", "βγδζθκλμνξπρστφχψ",
]
CHARACTERS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]

#: A word of a name; the repetition is bounded, as the pattern engine recurses on it.
WORD = r"(?:\p{Lu}['’])?\p{Lu}\p{Ll}++(?:[\-'’]?\p{Lu}\p{Ll}++){0,4}+"
NAMES = "|".join(n for names in FIRST.values() for n in names)
SALUTE = "|".join(TITLES)
#: kind: pattern, in order of preference; none can match an empty text.
KINDS = {
    "email": r"(?<![\w.%+\-])[A-Za-z0-9_%+\-][\w.%+\-]*+@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++){1,20}",
    "secret": rf"(?<![0-9A-Za-z])(?:[0-9a-f]{{32,}}+|[0-9A-F]{{32,}}+|(?:{PREFIXES})[A-Za-z0-9_\-]{{16,}}+)(?![0-9A-Za-z])",
    "iban": r"(?<![\p{L}\d])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\d])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)",
    "ipv6": r"(?<![\w:.])(?=[A-Fa-f:]{0,39}\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])",
    "phone": r"\+\d{1,3}[ \-.]?\(?\d{2,4}\)?(?:[ \-.]?\d{2,4}){2,3}(?!\d)|(?<![\d\w])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d\-])\d{3}-\d{3}-\d{4}(?![\d\-])|(?<![\w.\-])0\d{2,4} \d{3,4} \d{3,4}(?![\w\-])",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "card": r"(?<![\d.\w])\d{4}(?:[ \-]?\d{4}){2}[ \-]?\d{1,7}(?![\d\w])",
    "name": rf"(?=\p{{Lu}}|г-)(?<![\p{{L}}])(?:(?:{SALUTE})\.? {WORD}(?: (?:\p{{Lu}}\. )?{WORD})?|(?:{NAMES}) (?:\p{{Lu}}\. )?{WORD})(?![\p{{L}}])",
}
#: Found in a text only by what stands beside it; the kind of such an entity is told by its form.
BESIDE = [rf"(?<=[\"'])(?<=(?i:{ASSIGNED})[\"']{{0,1}} {{0,2}}[:=] {{0,2}}[\"'])[^\"'\s]{{8,400}}(?=[\"'])", f"[{HAN_SURNAMES}][一-鿿]{{1,2}}(?=先生|女士|小姐)"]
#: After a small ASCII letter no pattern can begin but at these characters: most places of a text are passed over by one look.
GUARD = rf"(?:(?<![a-z])|(?=[\d+{HAN_SURNAMES}]))"
PATTERN = GUARD + "(?:" + "|".join(f"(?:{p})" for p in [*KINDS.values(), *BESIDE]) + ")"
ROUNDS = 6


def kind_of(entity: Column) -> Column:
    """The first kind whose pattern is the whole entity; else a name if it is a name's words alone, else a secret."""
    out = None
    for kind, p in [*KINDS.items(), ("name", f"{WORD}|[{HAN_SURNAMES}][一-鿿]{{1,2}}")]:
        test = entity.rlike(f"^(?:{p})$")
        out = F.when(test, kind) if out is None else out.when(test, kind)
    return out.otherwise("secret")


def drawn(key: str, of: Column, what: str, most: int | Column) -> Column:
    """A keyed number from 0 to most - 1."""
    number = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(what), of), 256), 1, 15), 16, 10).cast("long")
    return F.pmod(number, most if isinstance(most, Column) else F.lit(most).cast("long"))


def feistel(key: str, a: Column, b: Column, size_a: Column, size_b: Column, what: str) -> tuple[Column, Column]:
    """Exchanges the pair (a, b) of numbers below size_a and size_b for another; a keyed bijection."""
    for r in range(0, ROUNDS, 2):
        a = F.pmod(a + drawn(key, b.cast("string"), f"{what}{r}", size_a), size_a)
        b = F.pmod(b + drawn(key, a.cast("string"), f"{what}{r + 1}", size_b), size_b)
    return a, b


def apply(value: Column, then) -> Column:
    """then(value) with value worked out once."""
    return F.transform(F.array(value), then)[0]


def power(n: Column) -> Column:
    """10 to the n, n up to 18, as a long."""
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("long")


def new_digits(key: str, digits: Column, what: str) -> Column:
    """As many digits, exchanged by a bijection; up to 36 digits."""

    def halves(d):
        left, right = (F.length(d) / 2).cast("int"), F.length(d) - (F.length(d) / 2).cast("int")
        start = F.struct(F.when(left > 0, F.left(d, left).cast("long")).otherwise(F.lit(0).cast("long")).alias("a"), F.right(d, right).cast("long").alias("b"))

        def step(acc, r):
            size_a, size_b = power(left), power(right)
            a = F.when(r % 2 == 0, F.pmod(acc["a"] + drawn(key, F.concat_ws("|", r.cast("string"), acc["b"].cast("string")), what, size_a), size_a)).otherwise(acc["a"])
            b = F.when(r % 2 == 1, F.pmod(acc["b"] + drawn(key, F.concat_ws("|", r.cast("string"), acc["a"].cast("string")), what, size_b), size_b)).otherwise(acc["b"])
            return F.struct(a.alias("a"), b.alias("b"))

        done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)
        return apply(done, lambda x: F.concat(F.when(left > 0, F.lpad(x["a"].cast("string"), left, "0")).otherwise(""), F.lpad(x["b"].cast("string"), right, "0")))

    return apply(digits, halves)


def placed(shape: Column, digits: Column) -> Column:
    """shape with its digits replaced, in order, by the given ones."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def step(acc, c):
        is_digit = c.rlike("^[0-9]$")
        return F.struct(F.concat(acc["out"], F.when(is_digit, F.substr(digits, acc["k"], F.lit(1))).otherwise(c)).alias("out"), (acc["k"] + is_digit.cast("int")).alias("k"))

    return F.aggregate(F.regexp_extract_all(shape, F.lit("(?s)."), F.lit(0)), start, step, lambda x: x["out"])


def check_sum(digits: Column) -> Column:
    """The Luhn sum modulo 10 of digits, as if a check digit stood to their right."""
    parts = F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("."), F.lit(0)), lambda c, i: F.when(i % 2 == 0, F.when(c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.pmod(F.aggregate(parts, F.lit(0), lambda a, b: a + b), F.lit(10))


def new_card(key: str, entity: Column) -> Column:
    """All digits but the last exchanged; the last keeps its distance from the right check digit."""

    def swap(d):
        body, last = F.left(d, F.length(d) - 1), F.right(d, F.lit(1)).cast("int")
        return apply(new_digits(key, body, "card"), lambda new: F.concat(new, F.pmod(last + check_sum(body) - check_sum(new), F.lit(10)).cast("string")))

    return placed(entity, apply(F.regexp_replace(entity, "[^0-9]", ""), swap))


def new_phone(key: str, entity: Column) -> Column:
    """The country code stays; the other digits are exchanged."""
    code = F.regexp_extract(entity, r"^(\+\d{1,3}(?=[ \-.(]))", 1)
    rest = F.substr(entity, F.length(code) + 1)
    return F.concat(code, placed(rest, new_digits(key, F.regexp_replace(rest, "[^0-9]", ""), "phone")))


def new_ip(key: str, entity: Column) -> Column:
    """Another dotted quad: a bijection of the 2**32 addresses."""
    o = F.split(entity, r"\.")
    n = [o[i].cast("long") for i in range(4)]
    a, b = feistel(key, n[0] * 256 + n[1], n[2] * 256 + n[3], F.lit(65536).cast("long"), F.lit(65536).cast("long"), "ip")
    return F.concat_ws(".", *[x.cast("string") for x in (F.shiftright(a, 8), a.bitwiseAND(F.lit(255).cast("long")), F.shiftright(b, 8), b.bitwiseAND(F.lit(255).cast("long")))])


def characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def shifted(c: Column, by: Column, classes: list[str]) -> Column:
    """The character that many places on within its class; one of no class stays."""
    out = c
    for letters in classes:
        at = F.instr(F.lit(letters), c)
        out = F.when(at > 0, F.substr(F.lit(letters), (F.pmod(at - 1 + by, F.lit(len(letters))) + 1).cast("int"), F.lit(1))).otherwise(out)
    return out


def han_shifted(c: Column, by: Column) -> Column:
    """The same for the 20,992 unified ideographs."""
    at = F.conv(F.hex(F.encode(c, "UTF-16BE")), 16, 10).cast("int") - 0x4E00
    return F.decode(F.unhex(F.lpad(F.hex((F.pmod(at + by * 7919, F.lit(20992)) + 0x4E00).cast("long")), 4, "0")), "UTF-16BE")


def exchanged(key: str, text: Column, what: str, shift) -> Column:
    """As many characters, each exchanged within its class: a Feistel network over the halves, so a bijection.

    shift(c, by) moves a character by places, and must keep its class.
    """

    def turn(r, half, other):
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(what), r.cast("string"), F.array_join(other, "")), 256)
        return apply(digest, lambda d: F.transform(half, lambda c, i: shift(c, F.conv(F.substr(d, F.pmod(i * 3, F.lit(62)) + 1, F.lit(3)), 16, 10).cast("int"))))

    def network(cs):
        half = (F.size(cs) / 2).cast("int")
        start = F.struct(F.slice(cs, F.lit(1), half).alias("a"), F.slice(cs, half + 1, F.size(cs)).alias("b"))

        def step(acc, r):
            a = F.when(r % 2 == 0, turn(r, acc["a"], acc["b"])).otherwise(acc["a"])
            b = F.when(r % 2 == 1, turn(r, acc["b"], acc["a"])).otherwise(acc["b"])
            return F.struct(a.alias("a"), b.alias("b"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda x: F.array_join(F.concat(x["a"], x["b"]), ""))

    return apply(characters(text), network)


def within(classes: list[str]):
    return lambda c, by: shifted(c, by, classes)


def new_email(key: str, entity: Column) -> Column:
    """Letters and digits for the local part, by the whole address; a reserved domain, by the domain."""
    domain = F.lower(F.substring_index(entity, "@", -1))
    whole = F.lower(entity)

    def letters(of, what, n):
        return F.translate(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(what), of), 256), 1, n), "0123456789abcdef", "bcdfghjklmnpqrst")

    tail = F.regexp_extract(F.substring_index(entity, "@", 1), r"([._\-]?)\d+$", 1)
    number = F.when(F.substring_index(entity, "@", 1).rlike(r"\d$"), F.concat(tail, F.lpad(drawn(key, whole, "tail", 100).cast("string"), 2, "0"))).otherwise("")
    end = F.when(domain.rlike(r"\.(com|org|net)$"), F.substring_index(domain, ".", -1)).otherwise("com")
    return F.concat(letters(whole, "local", 24), number, F.lit("@"), letters(domain, "host", 16), F.lit(".example."), end)


def new_secret(key: str, entity: Column) -> Column:
    """A vendor's prefix stays; hexadecimal digits become such digits of the same case, other characters others of their class."""
    prefix = F.regexp_extract(entity, f"^({PREFIXES})", 1)
    body = F.substr(entity, F.length(prefix) + 1)
    out = exchanged(key, body, "secret", within(CHARACTERS))
    for digits in ("0123456789ABCDEF", "0123456789abcdef"):
        out = F.when(entity.rlike(f"^[{digits}]+$"), exchanged(key, entity, "hex", within([digits]))).otherwise(out)
    return F.when(entity.rlike(f"^(?:{PREFIXES})"), F.concat(prefix, exchanged(key, body, "secret", within(CHARACTERS)))).otherwise(out)


def new_ipv6(key: str, entity: Column) -> Column:
    """Hexadecimal digits for each other, groups as long as they were, upper case if any was."""
    new = exchanged(key, F.lower(entity), "ipv6", within(["0123456789abcdef"]))
    return F.when(entity.rlike("[A-F]"), F.upper(new)).otherwise(new)


def right_check(country: Column, account: Column) -> Column:
    """The check number, 2 to 98, that ISO 7064 asks for."""
    values = F.transform(characters(F.concat(account, country, F.lit("00"))), lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1)
    return F.lit(98) - F.aggregate(values, F.lit(0), lambda acc, v: F.pmod(acc * F.when(v > 9, 100).otherwise(10) + v, F.lit(97)))


def new_iban(key: str, entity: Column) -> Column:
    """The country stays, the account is exchanged, the check number keeps its distance from the right one."""

    def swap(bare):
        country, account = F.left(bare, F.lit(2)), F.substr(bare, F.lit(5))
        check = F.substr(bare, F.lit(3), F.lit(2)).cast("int")
        new = exchanged(key, account, "iban", within([CHARACTERS[0], CHARACTERS[2]]))
        return apply(new, lambda n: F.concat(country, F.lpad(F.pmod(check - right_check(country, account) + right_check(country, n), F.lit(100)).cast("string"), 2, "0"), n))

    def spaced(new):
        start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
        step = lambda acc, c: F.struct(F.concat(acc["out"], F.when(c == " ", c).otherwise(F.substr(new, acc["k"], F.lit(1)))).alias("out"), (acc["k"] + (c != " ").cast("int")).alias("k"))
        return F.aggregate(characters(entity), start, step, lambda x: x["out"])

    return apply(apply(F.replace(entity, F.lit(" "), F.lit("")), swap), spaced)


def turned(key: str, values) -> dict[str, str]:
    """Each value's successor in a keyed order of them: a permutation that leaves none where it is."""
    order = sorted(values, key=lambda v: sha256(f"{key}|{v}".encode()).digest())
    return dict(zip(order, order[1:] + order[:1], strict=True))


def other_letters(key: str, word: Column) -> Column:
    """Letters exchanged within vowels or consonants of a script, case by place; a Cyrillic word keeps its last letter, which tells gender."""
    kept = F.when(word.rlike("[а-яё]$"), 1).otherwise(0)
    body = F.left(word, F.length(word) - kept)
    new = exchanged(key, F.lower(body), "name", within(LETTERS))
    cased = F.zip_with(characters(body), characters(new), lambda old, c: F.when(old != F.lower(old), F.upper(c)).otherwise(c))
    return F.concat(F.array_join(cased, ""), F.right(word, kept))


def name_word(key: str, word: Column) -> Column:
    """Another word for a word of a name: known first names and all other words are exchanged among themselves.

    An exchange that ends on a known first name goes on from there, which keeps it a bijection of the other words.
    """
    known = [n for names in FIRST.values() for n in names]
    other = {a: b for names in FIRST.values() for a, b in turned(key, names).items()}
    first = F.try_element_at(F.create_map(*[F.lit(v) for pair in other.items() for v in pair]), word)
    again = lambda w: F.aggregate(F.sequence(F.lit(0), F.lit(len(known))), w, lambda acc, _: F.when(acc.isin(known), other_letters(key, acc)).otherwise(acc))
    rest = apply(other_letters(key, word), lambda w: F.when(w.isin(known), again(w)).otherwise(w))
    return F.when(word.isin(known), first).otherwise(rest)


def name_words(entity: Column) -> Column:
    """A name's words without its title."""
    return F.split(F.regexp_replace(entity, rf"^(?:{SALUTE})\.? ", ""), " ")


def new_name(key: str, entity: Column) -> Column:
    title = F.regexp_extract(entity, rf"^((?:{SALUTE})\.? )", 1)
    surnames = turned(key, HAN_SURNAMES)
    han = F.concat(F.translate(F.left(entity, F.lit(1)), "".join(surnames), "".join(surnames.values())), exchanged(key, F.substr(entity, F.lit(2)), "han", han_shifted))
    return F.when(entity.rlike("^[一-鿿]"), han).otherwise(F.concat(title, F.array_join(F.transform(name_words(entity), lambda w: name_word(key, w)), " ")))


def surrogate(key: str, entity: Column, kind: Column) -> Column:
    makers = {"email": new_email, "iban": new_iban, "ip": new_ip, "ipv6": new_ipv6, "phone": new_phone, "ssn": lambda k, e: placed(e, new_digits(k, F.regexp_replace(e, "[^0-9]", ""), "ssn")), "card": new_card, "name": new_name}
    out = F.when(kind == "secret", new_secret(key, entity))
    for name, make in makers.items():
        out = out.when(kind == name, make(key, entity))
    return out


def lone_words(found: Column) -> Column:
    """A pattern for the words, of three letters or more, of the names among the entities; null if there is none."""
    names = F.filter(found, lambda e: e.rlike(f"^(?:{KINDS['name']})$"))
    words = F.array_distinct(F.filter(F.flatten(F.transform(names, name_words)), lambda w: w.rlike(f"^{WORD}$") & (F.length(w) > 2)))
    return F.when(F.size(words) > 0, F.concat(F.lit(rf"(?<![\p{{L}}\-'’])(?:"), F.array_join(words, "|"), F.lit(r")(?!\p{L}|[\-'’]\p{Lu})")))


def replace_pii(docs: DataFrame, key: str = "surrogates-1") -> DataFrame:
    """docs, all columns, with surrogates in text, and _entities: an array of (kind, entity, surrogate) in order.

    Null texts stay null, texts without an entity stay as they are; both have no entities. The same entity has the same
    surrogate in every row. No shuffle: a text is rewritten where it is read, whatever its length, in time linear in its
    entities. Columns of any name in docs stay; if one is called _entities, the new one is _entities_.
    """
    found, pattern, made, entities = spare(docs, "_found", "_pattern", "_made", "_entities")
    none = F.expr("cast(array() as array<struct<kind:string,entity:string,surrogate:string>>)")
    text = F.col("text")
    rows = docs.withColumn(found, F.when(text.isNotNull(), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))))
    rows = rows.withColumn(pattern, F.when(F.size(found) > 0, F.concat_ws("|", F.lit(PATTERN), lone_words(F.col(found)))))
    all_found = F.when(F.length(pattern) > len(PATTERN), F.regexp_extract_all(text, F.col(pattern), F.lit(0))).otherwise(F.col(found))
    kinds = F.transform(all_found, lambda e: F.struct(kind_of(e).alias("kind"), e.alias("entity")))
    whole = F.transform(kinds, lambda x: F.struct(x["kind"].alias("kind"), x["entity"].alias("entity"), surrogate(key, x["entity"], x["kind"]).alias("surrogate")))
    rows = rows.withColumn(made, F.when(F.size(found) > 0, whole).otherwise(none))
    pieces = F.zip_with(F.split(text, F.col(pattern), -1), made, lambda a, b: F.concat(a, F.coalesce(b["surrogate"], F.lit(""))))
    new = F.when(F.size(made) > 0, F.array_join(pieces, "")).otherwise(text)
    return rows.select(*[new.alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in docs.columns], F.col(made).alias(entities))


def collisions(replaced: DataFrame) -> DataFrame:
    """(kind, surrogate, n_entities) of surrogates that stand for several entities over the whole table; none may show.

    Spellings of one e-mail or IP address that differ in case or leading zeros are one entity.
    """
    pairs = replaced.select(F.explode("_entities").alias("e")).select("e.*")
    same = F.when(F.col("kind").isin("email", "ipv6"), F.lower("entity")).when(F.col("kind") == "ip", F.regexp_replace("entity", r"(?<!\d)0+(?=\d)", "")).otherwise(F.col("entity"))
    return pairs.select("kind", "surrogate", same.alias("entity")).distinct().groupBy("kind", "surrogate").agg(F.count("*").alias("n_entities")).where("n_entities > 1")
