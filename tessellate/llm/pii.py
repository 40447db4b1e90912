"""Personal data and secrets replaced by keyed, type-consistent surrogates.

DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

# Titles and given names that tell a gender, by script.
MALE_TITLES = "Mr Herr Señor Monsieur господин κύριος".split()
FEMALE_TITLES = "Mrs Ms Miss Frau Señora Señorita Madame Mademoiselle госпожа κυρία".split()
MALE_NAMES = """James John Robert Michael William David Richard Thomas Peter Paul Hans Klaus Jürgen Pierre Jean Jacques
Juan José Carlos Miguel Иван Пётр Сергей Γιώργος Νίκος""".split()
FEMALE_NAMES = """Mary Anna Maria Elizabeth Jennifer Linda Barbara Susan Sarah Emma Ursula Monika Sabine Marie Claire
Isabelle Carmen Lucía Ana Мария Елена Ольга Ελένη Μαρία""".split()
# Syllables that surrogate names are made of, and endings that tell the gender.
SYLLABLES = {"latin": "ba be da di fe ga ka ke la le li lo ma me mi na no pa ra re ri ro sa se so ta te ti to va ve vi wa ze".split(),
             "cyrillic": "ба ве га да ди жа за ка ла ле ли ма ми на не но па ра ре ри са се та ти то фе ша".split(),
             "greek": "βα γα δα δε ζα θε κα λα λε μα με μι να νε νο πα ρα ρι σα σο τα τε τι φα".split()}
ENDINGS = {"latin": ("n", "na", "r"), "cyrillic": ("н", "на", "р"), "greek": ("ς", "να", "ν")}  # male, female, surname

_NAME = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
_TITLE = "|".join(MALE_TITLES + FEMALE_TITLES)
_GIVEN = "|".join(MALE_NAMES + FEMALE_NAMES)
_ASSIGN = r"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?[ \t]{0,3}[=:][ \t]{0,3}[\"']?"
_DOMAIN = r"@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
# Kinds in the order in which they are tried at a place.
KINDS = {
    # letters of scripts with case, or of those without (often written without spaces before a Latin address)
    "email": r"(?:(?<![\p{Lu}\p{Ll}\p{M}\p{N}])[\p{Lu}\p{Ll}\p{N}][\p{Lu}\p{Ll}\p{M}\p{N}._%+-]{0,63}"
             r"|(?<![\p{L}\p{M}\p{N}])\p{Lo}[\p{Lo}\p{M}\p{N}._%+-]{0,63})" + _DOMAIN,
    "secret": r"(?<![\p{L}\p{N}])(?=[PpSsTtAa])" + _ASSIGN + r"(?=[^\s\"'\p{L}\p{N}]*+[\p{L}\p{N}])[^\s\"']{6,}+",
    "key": r"(?<![\p{L}\p{N}])(?:AKIA|ASIA)[0-9A-Z]{16}(?![\p{L}\p{N}])",
    "hex": r"(?<![\p{L}\p{N}])(?=[A-Fa-f]*+[0-9])[0-9A-Fa-f]{32,}+(?![\p{L}\p{N}])",
    "ip": r"(?<![\p{L}\p{N}.])(?:\d{1,3}\.){3}\d{1,3}(?![\p{L}\p{N}]|\.\d)",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}"
             r"|\+1[^\p{L}\p{N}\n]{0,6}\(\d{3}\)[^\p{L}\p{N}\n]{0,6}\d{3}-\d{4}|\d{3}-\d{3}-\d{4})(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "card": r"(?<![\p{L}\p{N}.-])\d(?:[ -]?\d){12,18}(?![\p{L}\p{N}])",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?=[\p{{Lu}}гκ])(?:(?:{_TITLE})\.? (?:(?:{_GIVEN}) )?{_NAME}|(?:{_GIVEN}) {_NAME})",
}
# Every other kind than e-mail begins where no letter or digit stands before, so most places are passed over by one look.
ENTITY = rf"(?:{KINDS['email']}|(?<![\p{{L}}\p{{N}}])(?:" + "|".join(p for k, p in KINDS.items() if k != "email") + "))"
MAX_ROUNDS = 40


def _kinds(values: DataFrame) -> DataFrame:
    """``value, kind, lead, core, part, part_kind, norm`` of distinct matches: the lead is
    kept, the core replaced part by part; parts with the same norm are the
    same entity however they are written."""
    kind = None
    for k, pattern in KINDS.items():
        hit = F.regexp_extract("value", f"^(?:{pattern})$", 0) != ""
        kind = F.when(hit, k) if kind is None else kind.when(hit, k)
    title = rf"^(?:(?:{_TITLE})\.? )?"
    lead = (F.when(F.col("kind") == "secret", F.regexp_extract("value", "^" + _ASSIGN, 0))
            .when(F.col("kind") == "key", F.substring("value", 1, 4))
            .when(F.col("kind") == "name", F.regexp_extract("value", title, 0)).otherwise(""))
    v = values.withColumn("kind", F.coalesce(kind, F.lit("secret"))).withColumn("lead", lead)
    v = v.withColumn("core", F.expr("substring(value, length(lead) + 1)"))
    words = F.split("core", " ")
    # of a name the title or the given name tells the gender
    female = F.col("lead").rlike(rf"^(?:{'|'.join(FEMALE_TITLES)})\b") | F.element_at(words, 1).isin(FEMALE_NAMES)
    script = F.when(F.col("core").rlike(r"\p{IsCyrillic}"), "cyrillic").when(F.col("core").rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    given = F.concat(F.lit("given-"), F.when(female, "female").otherwise("male"), F.lit("-"), script)
    surname = F.concat(F.lit("surname-"), script)
    digits = F.regexp_replace("core", "[^0-9+]", "")
    norm = (F.when(F.col("kind") == "email", F.lower("core")).when(F.col("kind").isin("phone", "ssn", "card"), digits)
            .when(F.col("kind") == "iban", F.regexp_replace("core", " ", "")).otherwise(F.col("core")))
    one = F.array(F.struct(F.when(F.col("kind") == "hex", "secret").otherwise(F.col("kind")).alias("part_kind"), norm.alias("norm")))
    last = F.struct(surname.alias("part_kind"), F.lower(F.element_at(words, -1)).alias("norm"))
    first = F.struct(given.alias("part_kind"), F.lower(F.element_at(words, 1)).alias("norm"))
    parts = F.when(F.col("kind") != "name", one).when(F.size(words) > 1, F.array(first, last)).otherwise(F.array(last))
    return v.select("value", "kind", "lead", "core", F.posexplode(parts).alias("part", "p")).select(
        "value", "kind", "lead", "core", "part", "p.part_kind", "p.norm")


def _expressions() -> tuple[str, str, str]:
    """SQL of the hash stream of (secret_key, part_kind, norm, attempt), of a text of the
    same shape drawn from it, and of the surrogate by its kind."""
    stream = ("array_join(transform(sequence(0, length(norm) div 32), "
              "b -> sha2(concat_ws('\\u001f', secret_key, part_kind, norm, attempt, b), 256)), '')")
    pair = "cast(conv(substring(stream, 2 * i - 1, 2), 16, 10) as int)"
    char = "substring(norm, i, 1)"
    hexed = "(part_kind = 'secret' and norm rlike '^([0-9a-f]+|[0-9A-F]+)$')"
    same_shape = f"""array_join(transform(sequence(1, length(norm)), i ->
        case when i <= kept or (part_kind = 'email' and i > length(norm) - length(substring_index(norm, '.', -1))) then {char}
             when {char} between '0' and '9' then cast({pair} % 10 as string)
             when {char} between 'a' and 'z' then substring('abcdefghijklmnopqrstuvwxyz', 1 + {pair} % if({hexed}, 6, 26), 1)
             when {char} between 'A' and 'Z' then substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ', 1 + {pair} % if({hexed}, 6, 26), 1)
             when part_kind in ('email', 'secret') and {char} rlike '[\\\\p{{L}}\\\\p{{N}}]' then substring('abcdefghijklmnopqrstuvwxyz', 1 + {pair} % 26, 1)
             else {char} end), '')"""
    ip = f"array_join(transform(sequence(1, 4), i -> cast(1 + {pair} % 254 as string)), '.')"

    def name(script: str, ending: str) -> str:
        listed = ", ".join(f"'{s}'" for s in SYLLABLES[script])
        made = f"transform(sequence(1, 3 + attempt div 4), i -> element_at(array({listed}), 1 + {pair} % {len(SYLLABLES[script])}))"
        return f"concat(array_join({made}, ''), '{ending}')"

    cases = " ".join(
        f"when part_kind = '{k}' then {name(script, ENDINGS[script][i])}"
        for script in SYLLABLES for i, k in enumerate((f"given-male-{script}", f"given-female-{script}", f"surname-{script}")))
    # a card number that satisfies its check digit is replaced by one that does
    luhn = ("aggregate(sequence(1, length({s})), 0L, (acc, i) -> acc + case when i % 2 = 1 then cast(substring(reverse({s}), i, 1) as int) "
            "else (2 * cast(substring(reverse({s}), i, 1) as int)) div 10 + (2 * cast(substring(reverse({s}), i, 1) as int)) % 10 end)")
    body = "substring(shape, 1, length(norm) - 1)"
    digit = f"(10 - {luhn.format(s=f'concat({body}, 0)')} % 10) % 10"
    card = f"if({luhn.format(s='norm')} % 10 = 0, concat({body}, cast({digit} as string)), shape)"
    # a secret of few letters and digits gets longer with the attempts, as names do
    return stream, same_shape, (f"case when part_kind = 'ip' then {ip} when part_kind = 'card' then {card} {cases} "
                                f"when part_kind = 'secret' and attempt >= 8 then concat(shape, substring(stream, 1, attempt div 8)) else shape end")


def _with_candidates(entities: DataFrame, key: str) -> DataFrame:
    stream, shape, chosen = _expressions()
    kept = F.when(F.col("part_kind") == "card", 1).when((F.col("part_kind") == "phone") & F.col("norm").startswith("+"), 2).when(
        F.col("part_kind") == "iban", 4).otherwise(0)
    return (entities.withColumn("secret_key", F.lit(key)).withColumn("kept", kept).withColumn("stream", F.expr(stream))
            .withColumn("shape", F.expr(shape)).withColumn("surrogate", F.expr(chosen))
            .select("part_kind", "norm", "attempt", "surrogate"))


def assign(entities: DataFrame, key: str) -> DataFrame:
    """``part_kind, norm, attempt, surrogate`` for distinct ``(part_kind, norm)``.

    The surrogate is drawn from a hash of the key, the kind, the entity and the
    attempt. Of entities that drew the same surrogate all but one draw again,
    as does one whose surrogate is itself an entity of the corpus, until all
    differ; names get longer with the attempts.
    """
    current = stored(_with_candidates(entities.withColumn("attempt", F.lit(0)), key), "surrogates")
    order = W.partitionBy("part_kind", "surrogate").orderBy("attempt", "norm")
    for _ in range(MAX_ROUNDS):
        real = entities.select(F.col("part_kind").alias("k"), F.col("norm").alias("real"))
        marked = (current.withColumn("nth", F.row_number().over(order))
                  .join(real, (F.col("part_kind") == F.col("k")) & (F.col("surrogate") == F.col("real")), "left")
                  .select("part_kind", "norm", "attempt", "surrogate", ((F.col("nth") > 1) | F.col("real").isNotNull()).alias("again")))
        marked = stored(marked, "surrogates")
        if marked.where("again").isEmpty():
            return marked.drop("again")
        redrawn = _with_candidates(marked.where("again").select("part_kind", "norm", (F.col("attempt") + 1).alias("attempt")), key)
        current = marked.where(~F.col("again")).drop("again").union(redrawn)
    raise RuntimeError(f"surrogates still collide after {MAX_ROUNDS} rounds")


def replacements(values: DataFrame, key: str) -> DataFrame:
    """``value, replacement`` for distinct matches: the surrogates of its parts in the
    spacing, punctuation and case of the match."""
    parts = stored(_kinds(values), "entity-parts")
    drawn = assign(parts.select("part_kind", "norm").distinct(), key).select(
        F.col("part_kind").alias("k"), F.col("norm").alias("n"), "surrogate")
    whole = (parts.join(drawn, (F.col("part_kind") == F.col("k")) & (F.col("norm") == F.col("n")))
             .groupBy("value", "kind", "lead", "core").agg(F.sort_array(F.collect_list(F.struct("part", "surrogate"))).alias("parts")))
    surrogate = "element_at(parts, 1).surrogate"
    spaced = f"""array_join(transform(sequence(1, length(core)), i ->
        case when substring(core, i, 1) rlike if(kind = 'iban', '[A-Z0-9]', '[0-9+]') then
               substring({surrogate}, length(regexp_replace(substring(core, 1, i), if(kind = 'iban', ' ', '[^0-9+]'), '')), 1)
             else substring(core, i, 1) end), '')"""
    cased = f"""array_join(transform(sequence(1, length(core)), i ->
        if(substring(core, i, 1) between 'A' and 'Z', upper(substring({surrogate}, i, 1)), substring({surrogate}, i, 1))), '')"""
    name = "array_join(transform(parts, p -> initcap(p.surrogate)), ' ')"
    core = F.expr(f"case when kind in ('phone', 'ssn', 'card', 'iban') then {spaced} when kind = 'email' then {cased} "
                  f"when kind = 'name' then {name} else {surrogate} end")
    return whole.select("value", F.concat("lead", core).alias("replacement"))


def pseudonymise(docs: DataFrame, key: str = "tessellate") -> DataFrame:
    """Every row of ``docs`` with the entities in ``text`` replaced, and ``n_entities``.

    The same entity has the same surrogate in all documents, in whatever
    spacing or case it is written; different entities have different ones.
    Texts with entities are grouped by their digest, so that copies are
    looked up once; texts without any pass through where they are read.

    Null and empty texts stay as they are with no entities; rows without
    doc_id and repeated rows are treated like any other; an empty table gives
    no rows; all columns are kept (one named ``n_entities`` is replaced).
    """
    columns = [c for c in docs.columns if c != "n_entities"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col("text").cast("string").alias("body"))
    found = F.coalesce(F.col("body").rlike(ENTITY), F.lit(False))
    spans = F.regexp_extract_all("body", F.lit(ENTITY), F.lit(0))
    # read once more than needed here, but not searched again
    hits = stored(rows.where(found).withColumn("digest", F.sha2("body", 256)).withColumn("spans", spans), "entity-texts")
    spans = F.col("spans")
    pairs = stored(hits.select("digest", F.explode(F.array_distinct(spans)).alias("value")).distinct(), "entities")
    swap = replacements(pairs.select("value").distinct(), key).select(F.col("value").alias("v"), "replacement")
    # stored, so that the join below shuffles both sides itself and can split the copies of one text
    by_text = stored(pairs.join(swap, F.col("value") == F.col("v")).groupBy(F.col("digest").alias("of_digest"))
                     .agg(F.map_from_entries(F.collect_list(F.struct("value", "replacement"))).alias("swap")), "surrogates-of")
    put = F.zip_with(F.split("body", ENTITY, -1), F.transform(spans, lambda s: F.element_at("swap", s)),
                     lambda text, r: F.concat(text, F.coalesce(r, F.lit(""))))
    changed = hits.join(by_text, F.col("digest") == F.col("of_digest")).select(
        "row", F.array_join(put, "").alias("body"), F.size(spans).alias("n_entities"))
    same = rows.where(~found).select("row", "body", F.lit(0).alias("n_entities"))
    return changed.union(same).select(
        *[F.col("body").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in columns],
        F.col("n_entities").cast("long").alias("n_entities"))
