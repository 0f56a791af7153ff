"""Replace personal data by surrogates, on built-in functions alone.

Entities are found by patterns. Every distinct entity of the corpus gets one
surrogate: drawn with a key, of the same type, length and script, and for names
of the same gender, checked against all other surrogates and all real entities.
Texts then take it wherever the entity stands, in the form it has there. So
different entities stay different, and one entity stays one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeweir.llm.common import saved

# Patterns of entities, in the order in which they are tried.
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_H = "[0-9A-Fa-f]{1,4}"
#: All eight groups, or up to seven of them around one "::", which alone is no one's address.
_V6 = "|".join([f"(?:{_H}:){{7}}(?:{_H}|:)", *(f"(?:{_H}:){{{n}}}:(?:{_H}(?::{_H}){{0,{6 - n}}})?" for n in range(6, 0, -1)), f"::{_H}(?::{_H}){{0,6}}"])
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{N}._%+-]*@(?:[\p{L}\p{N}-]+\.)+\p{L}{2,}",
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-fA-F]{32,}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9]{20,}|"
    r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})(?![\p{L}\p{N}])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ipv6": rf"(?<![\p{{L}}\p{{N}}:])(?=[0-9A-Fa-f]{{0,4}}:[0-9A-Fa-f:])(?:{_V6})(?![\p{{L}}\p{{N}}:]|\.[0-9])",
    "ipv4": rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\p{{N}}]|\.[0-9])",
    "ssn": r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\p{L}\p{N}-])",
    "card": r"(?<![\p{L}\p{N}])(?:(?:[0-9]{4}[ -]?){3}[0-9]{1,7}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|"
    r"\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![\p{L}\p{N}])",
}
#: Forms of address that a name follows, by the gender that they tell.
TITLES = {
    "m": "Mr Herr Herrn Monsieur Señor Sr Sir Signor Senhor господин Г-н г-н Κύριος κύριος κ".split(),
    "f": "Mrs Ms Miss Frau Fräulein Madame Mme Mademoiselle Mlle Señora Señorita Sra Srta Signora Senhora Lady госпожа г-жа Κυρία κυρία".split(),
    "u": "Mx Dr Prof Professor Doktor Docteur Doctor доктор".split(),
}
_TITLE = "(?:" + "|".join(sorted((t for ts in TITLES.values() for t in ts), key=lambda t: (-len(t), t))) + ")"
_WORD = r"\p{Lu}[\p{Ll}\p{M}'’]+"
PATTERNS["name"] = rf"(?<![\p{{L}}\p{{N}}]){_TITLE}\.?[  ]{_WORD}(?:[  -]{_WORD}){{0,2}}"
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every entity has one of, to pass over most texts quickly.
HINT = rf"[0-9@]|{_TITLE}\.?[  ]\p{{Lu}}|eyJ|sk-|gh[pousr]_|AKIA|[a-fA-F]{{32}}|::|[a-fA-F]:[a-fA-F]"

#: Syllables that surrogate names are made of, by script, and endings by gender.
SYLLABLES = {
    "latin": ("bar cal dor fen gil har jon kel lor mar nel per ros sel tor val wen".split(), "an el in or ur as ed il om al er is on ab et im".split()),
    "cyrillic": ("бар вел гор дан зим кор лад мил нед пол рад сел тих фед яр жар".split(), "ан ел ин ор ур ас ед ил ом ал ер ис он аб ет им".split()),
    "greek": ("βαρ γελ δορ ζαν θεμ καλ λορ μαρ νελ περ ροσ σελ τορ φαν χαρ ψελ".split(), "αν ελ ιν ορ ουρ ας εδ ιλ ομ αλ ερ ις ον αβ ετ ιμ".split()),
}
ENDINGS = {
    "latin": {"m": "o", "f": "a", "u": "y", "family": "sen"},
    "cyrillic": {"m": "", "f": "а", "u": "и", "family": "енко"},
    "greek": {"m": "ος", "f": "α", "u": "ι", "family": "ιδη"},
}
#: Rounds of draws after which the space of surrogates counts as used up.
MOST_ROUNDS = 60


def _sql_list(words) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")"


def _draw(i: str, n: int) -> str:
    """A number below ``n`` from place ``i`` of the random ``stream``."""
    return f"(cast(conv(substring(stream, 1 + 4 * (({i}) % 60), 4), 16, 10) AS INT) % {n})"


def _swapped(text: str, hexadecimal: str = "false") -> str:
    """Each digit and letter of ``text`` by another of its class and script; other characters stay."""
    classes = [("[0-9]", "0123456789"), ("[a-z]", "abcdefghijklmnopqrstuvwxyz"), ("[A-Z]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
               ("[а-я]", "абвгдежзийклмнопрстуфхцчшщъыьэюя"), ("[α-ω]", "αβγδεζηθικλμνξοπρστυφχψω")]
    cases = [f"WHEN c RLIKE '{pattern}' THEN substring('{letters}', 1 + {_draw('i', len(letters))}, 1)" for pattern, letters in classes]
    hexed = [f"WHEN {hexadecimal} AND c RLIKE '[a-f]' THEN substring('abcdef', 1 + {_draw('i', 6)}, 1)",
             f"WHEN {hexadecimal} AND c RLIKE '[A-F]' THEN substring('ABCDEF', 1 + {_draw('i', 6)}, 1)"]
    # A letter beyond these alphabets becomes a Latin one, so that none of the original stays.
    rest = f"WHEN c RLIKE '\\\\p{{L}}|\\\\p{{N}}' THEN substring('abcdefghijklmnopqrstuvwxyz', 1 + {_draw('i', 26)}, 1)"
    return f"array_join(transform(split({text}, ''), (c, i) -> CASE {' '.join([*hexed, *cases, rest])} ELSE c END), '')"


def _luhn(digits: str) -> str:
    """The Luhn sum of a string of digits, modulo 10."""
    twice = "CASE WHEN 2 * cast(d AS INT) > 9 THEN 2 * cast(d AS INT) - 9 ELSE 2 * cast(d AS INT) END"
    return f"(aggregate(transform(split(reverse({digits}), ''), (d, i) -> CASE WHEN i % 2 = 1 THEN {twice} ELSE cast(d AS INT) END), 0, (a, b) -> a + b) % 10)"


def _iban(country: str, rest: str) -> str:
    """Country, check digits and account number, with the check that the account number needs."""
    numbers = f"array_join(transform(split(concat({rest}, {country}, '00'), ''), c -> CASE WHEN c RLIKE '[A-Z]' THEN cast(ascii(c) - 55 AS STRING) ELSE c END), '')"
    modulo = f"aggregate(split({numbers}, ''), 0, (a, d) -> (a * 10 + cast(d AS INT)) % 97)"
    return f"concat({country}, lpad(cast(98 - {modulo} AS STRING), 2, '0'), {rest})"


def _name(script: str, kind: str) -> str:
    heads, tails = SYLLABLES[script]
    part = lambda i, words: f"element_at({_sql_list(words)}, 1 + {_draw(i, len(words))})"
    more = f"CASE WHEN attempt > 2 THEN {part('9', heads)} ELSE '' END, CASE WHEN attempt > 5 THEN {part('11', heads)} ELSE '' END"
    return f"concat({part('1', heads)}, {part('3', tails)}, {part('5', heads)}, {part('7', tails)}, {more}, '{ENDINGS[script][kind]}')"


def _surrogate() -> Column:
    """The draw for ``(type, canon, attempt)`` from ``stream``; types of names end in their script."""
    card = f"concat(substring(canon, 1, 1), substring({_swapped('canon')}, 2))"
    fixed = f"concat(substring(s, 1, length(s) - 1), cast((cast(right(s, 1) AS INT) + {_luhn('canon')} - {_luhn('s')} + 10) % 10 AS STRING))"
    local, domain = "substring_index(canon, '@', 1)", "substring_index(canon, '@', -1)"
    labels = f"left({domain}, length({domain}) - length(substring_index({domain}, '.', -1)) - 1)"
    cases = {
        # The domain is drawn by itself, so that addresses of one domain keep one.
        "email": f"concat({_swapped(local)}, '@', {_swapped(labels).replace('stream', 'domain_stream')}, '.example')",
        "secret": f"concat(regexp_extract(canon, '^(AKIA|gh[pousr]_|sk-|eyJ|)', 1), {_swapped('regexp_replace(canon, \"^(AKIA|gh[pousr]_|sk-|eyJ)\", \"\")', 'canon RLIKE \"^[0-9a-fA-F]+$\"')})",
        "iban": _iban("left(canon, 2)", f"{_swapped('substring(canon, 5)')}"),
        # Short groups have few draws; where those are used up, they become long ones.
        "ipv6": f"CASE WHEN attempt > 5 THEN regexp_replace({_swapped('canon', 'true')}, '(?<![0-9a-f])[0-9a-f]{{1,3}}(?![0-9a-f])', "
        f"concat(translate(substring(stream, 241, 1), '0', 'f'), substring(stream, 242, 3))) ELSE {_swapped('canon', 'true')} END",
        "ipv4": f"concat_ws('.', 11 + {_draw('1', 116)}, {_draw('2', 256)}, {_draw('3', 256)}, {_draw('4', 256)})",
        "ssn": f"concat(1 + {_draw('0', 8)}, substring({_swapped('canon')}, 2))",
        "card": f"element_at(transform(array({card}), s -> {fixed}), 1)",
        "phone": f"concat(substring_index(canon, '|', 1), '|', {_swapped('substring_index(canon, \"|\", -1)')})",
    }
    for script in SYLLABLES:
        for kind in ENDINGS[script]:
            cases[f"name_{kind}_{script}"] = _name(script, kind)
    return F.expr("CASE type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in cases.items()) + " END")


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``(type, canon, surrogate)`` for distinct ``(type, canon)`` rows.

    Each draw is keyed and numbered. One that equals a real entity of its type,
    or that an entity has already, is drawn again; of several new ones the least
    keeps it. Rounds go on until none is left, whatever their number at the
    start; each writes the table once.
    """
    real = entities.select(F.col("type").alias("t"), F.col("canon").alias("c"))
    seed = lambda *parts: F.sha2(F.concat_ws("\x1f", F.lit(key), *parts), 512)
    rows = entities.withColumns({"attempt": F.lit(0), "fixed": F.lit(False), "surrogate": F.lit("")})
    for _ in range(MOST_ROUNDS):
        stream = F.concat(seed("type", "canon", "attempt"), seed("type", "canon", "attempt", F.lit("+")))
        domain = F.concat(*[seed(F.substring_index("canon", "@", -1), F.lit(x)) for x in "ab"])
        drawn = rows.where("NOT fixed").withColumns({"stream": stream, "domain_stream": domain}).withColumn("surrogate", _surrogate()).drop("stream", "domain_stream")
        both = rows.where("fixed").unionByName(drawn)
        first = F.row_number().over(Window.partitionBy("type", "surrogate").orderBy(F.col("fixed").desc(), "canon"))
        checked = both.withColumn("place", first).join(real, (F.col("type") == F.col("t")) & (F.col("surrogate") == F.col("c")), "left")
        checked = checked.withColumn("fixed", (F.col("place") == 1) & F.col("c").isNull()).drop("place", "t", "c")
        rows = saved(checked.withColumn("attempt", F.col("attempt") + (~F.col("fixed")).cast("int")), "assigned")
        if rows.where("NOT fixed").isEmpty():
            return rows.select("type", "canon", "surrogate")
    raise RuntimeError("surrogates of some type are used up")


def _parts() -> Column:
    """The pieces of an entity: ``(kind, canon, piece)``; a piece without kind stays as it is."""
    found = F.col("found")
    is_a = lambda name: F.regexp_like(found, F.lit(f"^(?:{PATTERNS[name]})$"))
    digits = F.regexp_replace(found, "[^0-9]", "")
    country = F.regexp_extract(found, r"^\+([0-9]{1,3})(?=[ .(-])", 1)
    one = lambda kind, canon: F.array(F.struct(F.lit(kind).alias("kind"), canon.alias("canon"), found.alias("piece")))
    # A name: its title stays, the last word is the family's, words before it are given ones.
    gender = F.when(found.rlike(f"^(?:{'|'.join(TITLES['f'])})(?![\\p{{L}}])"), "f").when(found.rlike(f"^(?:{'|'.join(TITLES['m'])})(?![\\p{{L}}])"), "m").otherwise("u")
    title = F.regexp_extract(found, rf"^({_TITLE}\.?[  ])", 1)
    tokens = F.regexp_extract_all(F.substring(found, F.length(title) + 1, F.length(found)), F.lit(r"[  -]?[^  -]+"), F.lit(0))

    def word(token, i):
        bare = F.regexp_replace(token, r"^[  -]", "")
        script = F.when(bare.rlike(r"\p{IsCyrillic}"), "cyrillic").when(bare.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
        role = F.when(i == F.size(tokens) - 1, "family").otherwise(gender)
        return F.struct(F.concat_ws("_", F.lit("name"), role, script).alias("kind"), F.lower(bare).alias("canon"), token.alias("piece"))

    stays = F.array(F.struct(F.lit("").alias("kind"), F.lit("").alias("canon"), title.alias("piece")))
    return (
        F.when(is_a("email"), one("email", F.lower(found)))
        .when(is_a("secret"), one("secret", found))
        .when(is_a("iban"), one("iban", F.regexp_replace(found, " ", "")))
        .when(is_a("ipv6"), one("ipv6", F.lower(found)))
        .when(is_a("ipv4"), one("ipv4", found))
        .when(is_a("ssn"), one("ssn", digits))
        .when(is_a("card"), one("card", digits))
        .when(is_a("name"), F.concat(stays, F.transform(tokens, word)))
        .otherwise(one("phone", F.concat(country, F.lit("|"), F.substring(digits, F.length(country) + 1, F.length(digits)))))
    )


def _rendered() -> Column:
    """The surrogate in the form of the piece that it stands for."""
    plain = F.regexp_replace("surrogate", r"\|", "")
    # Digits and letters of the surrogate go, in order, where the piece has digits and letters.
    filled = F.expr(
        "array_join(transform(split(piece, ''), (c, i) -> CASE WHEN c RLIKE '[0-9A-Za-z]' THEN "
        "substring(regexp_replace(surrogate, '[|]', ''), length(regexp_replace(substring(piece, 1, i + 1), '[^0-9A-Za-z]', '')), 1) ELSE c END), '')"
    )
    lead = F.regexp_extract("piece", r"^([  -]?)", 1)
    return (
        F.when(F.col("kind") == "", F.col("piece"))
        .when(F.col("kind").isin("ssn", "card", "phone", "iban"), filled)
        .when(F.col("kind").startswith("name"), F.concat(lead, F.initcap(plain)))
        .when((F.upper("piece") == F.col("piece")) & (F.col("kind") != "secret") & (F.lower("piece") != F.col("piece")), F.upper(plain))
        .otherwise(plain)
    )


def with_surrogates(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text, n_entities)``: each row with its entities replaced.

    Texts without an entity are returned as they are and are not shuffled. Equal
    texts are worked on once. A null text stays null and an empty one empty,
    with 0 entities. The same key gives the same surrogates for the same set of
    entities; another key gives others. Repeated rows each have a result, other
    columns are not read.
    """
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = F.when(F.regexp_like("text", F.lit(HINT)), F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)))
    marked = named.withColumn("found", F.coalesce(found, F.array().cast("array<string>")))
    with_any = marked.where(F.size("found") > 0).withColumn("text_key", F.xxhash64("text"))
    spots = saved(with_any.groupBy("text_key").agg(F.first("found").alias("found")), "entities")
    pieces = spots.select("text_key", F.posexplode("found").alias("place", "found"))
    pieces = saved(pieces.select("text_key", "place", F.posexplode(_parts()).alias("part", "p")).select("text_key", "place", "part", "p.*"), "pieces")
    entities = pieces.where("kind <> ''").select(F.col("kind").alias("type"), "canon").distinct()
    surrogates = assign(entities, key)
    known = pieces.join(surrogates, (F.col("kind") == F.col("type")) & (pieces["canon"] == surrogates["canon"]), "left")
    # As many rows as the text has entities, and as many parts as a name has.
    parts = known.select("text_key", "place", F.struct("part", _rendered().alias("now")).alias("part"))
    whole_entities = parts.groupBy("text_key", "place").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    whole_entities = whole_entities.select("text_key", F.struct("place", F.array_join("parts.now", "").alias("now")).alias("entity"))
    by_text = whole_entities.groupBy("text_key").agg(F.array_sort(F.collect_list("entity")).alias("entities"))
    replaced = with_any.join(by_text.withColumnRenamed("text_key", "key"), F.col("text_key") == F.col("key")).withColumn("new", F.col("entities.now"))
    between = F.split("text", F.lit(ENTITY), -1)
    whole = F.array_join(F.transform(F.arrays_zip(between.alias("a"), F.col("new").alias("b")), lambda z: F.concat(z["a"], F.coalesce(z["b"], F.lit("")))), "")
    done = replaced.select("doc_id", whole.alias("text"), F.size("found").cast("long").alias("n_entities"))
    return marked.where(F.size("found") == 0).select("doc_id", "text", F.lit(0).cast("long").alias("n_entities")).unionByName(done)
