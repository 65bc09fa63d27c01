"""Personal data replaced by keyed surrogates of the same type and format.

Kinds: e-mail addresses, IPv4 addresses, card, social security, bank account and phone
numbers, and names after titles: all following capitalised words, initials and particles,
the last word as family name. In the same document these names are replaced without a title
too: the whole name, its family name and its given names. The entity behind a mention is its core (digits of a
number, the lower-cased address, the family name in any case), so all mentions of one entity
get the same surrogate in each mention's own format; a name in capitals stays in capitals. Surrogates follow from a keyed hash: digits for
digits, letters for letters, a card's first digit and a valid check digit, family names in the
mention's script. A given name with its family name and gender is an entity of its own
(``full``): its surrogate fits the gender, and no other full name of that family has it.
Given names come from a short list first, from more and more syllables when drawn again;
initials stay initials, particles stay. After a title for both genders a full name is the one
that occurs with a gender, if there is one.

Distinct cores must have distinct surrogates, and none may be a core that occurs. Both
are checked for all entities of the corpus; the losers of a collision draw again until
there is none (at most ``ROUNDS`` times, then an error).

Only DataFrame functions. Entities are made distinct before they are shuffled; texts
without personal data aren't moved. Every input row gives one output row; null stays
null; repeated rows are rewritten alike; an empty table gives an empty one.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

ROUNDS = 20
_WORD = r"[A-Za-z0-9._%+-]"
# Titles that tell a gender.
MALE, FEMALE = "Mr|Herr|Monsieur|Señor|Sr|Signor|г-н", "Mrs|Ms|Miss|Frau|Mme|Madame|Señora|Sra|Signora|г-жа"
BOTH = "Dr|Prof|Professor|Professeur|Profesor|Profesora|Dott|Dottor|Dottoressa|Docteur|Doctor|Doktor|д-р|Доктор|Профессор"
_TITLES = rf"(?:(?:{MALE}|{FEMALE}|{BOTH})\.? )+"
_PARTICLE = "(?:von|van|vom|der|den|dem|de|del|della|dei|di|da|das|do|dos|du|la|le|los|zu|zur|zum|af|av|bin|ibn|el|al|ter|ten|y|e)"
_CAPITAL = r"\p{Lu}[\p{L}\p{M}'’-]+"
_INITIAL = r"\p{Lu}(?:\.(?:-?\p{Lu}\.)*|(?![\p{L}\p{M}'’-]))"
GIVEN = {"m": "Adam Boris Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leo".split(),
         "f": "Anna Bella Clara Diana Emma Flora Greta Helen Irene Julia Karin Lena".split()}
GIVEN_CYRILLIC = {"m": "Антон Борис Виктор Глеб Денис Егор Захар Иван Кирилл Лев Максим Олег".split(),
                  "f": "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лидия Мария Ольга".split()}
PATTERNS = [
    ("email", rf"(?<!{_WORD}){_WORD}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    ("ip", r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"),
    ("ssn", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
    ("iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"),
    ("card", r"(?<![0-9A-Za-z+-])(?:[0-9]{4}[ -]){3}[0-9]{4}(?![0-9A-Za-z])|(?<![0-9A-Za-z+-])[0-9]{13,19}(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z])"
              r"|(?<![0-9A-Za-z])\+[0-9]{8,15}(?![0-9A-Za-z])"),
    ("name", rf"(?<![\p{{L}}]){_TITLES}(?:(?:{_CAPITAL}|{_INITIAL}|{_PARTICLE}) )*{_CAPITAL}"),
]
KINDS = [k for k, _ in PATTERNS]
FULL = "full"  # given names within a family: not a pattern's kind
_SYLLABLES = "ba de fi go ku la me ni po ra se ti vo wa ze lo".split()
_CAPITALS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ")
_LATIN, _CYRILLIC = "BDFGKLMNPRSTVWZabcdefgiklmnoprstuvwz", "БДФГКЛМНПРСТВУЗабцдефгиклмнопрстувуз"
# All kinds in their order. The tests in front follow from the patterns (nothing but an
# address of digits begins after an ASCII letter, and none of the later kinds with a small
# one) and spare most places of a text the single patterns.
_OF = {k: f"(?:{p})" for k, p in PATTERNS}
ANY = (f"{_OF['email']}|(?=[0-9]){_OF['ip']}|(?=[0-9A-Z+(гдДП])(?<![A-Za-z])(?:"
       + "|".join(_OF[k] for k in KINDS[2:]) + ")")


def _digits(v):
    return F.regexp_replace(v, "[^0-9]", "")


def kind_of(value):
    return reduce(lambda w, kp: w.when(value.rlike(f"^(?:{kp[1]})$"), kp[0]), PATTERNS, F.when(F.lit(False), ""))


def _folded(word):
    """A word of a name as it is written in the middle of a sentence; initials and particles as they are."""
    return F.when(word.rlike(f"^{_CAPITAL}$"), F.initcap(word)).otherwise(word)


def _cased(new, word):
    """The new word in capitals if the old one is."""
    return F.when((F.upper(word) == word) & (F.length(word) > 1), F.upper(new)).otherwise(new)


def core_of(kind, value):
    number = _digits(value)
    return (F.when(kind == "email", F.lower(value)).when(kind == "ip", value)
            .when(kind == "name", _folded(F.element_at(F.split(value, " "), -1)))
            .when(kind == "iban", F.regexp_replace(value, " ", ""))
            .when(kind == "phone", F.substring(number, F.greatest(F.lit(1), F.length(number) - 9), F.lit(10)))
            .otherwise(number))


def _drawn(core, hexes):
    """Each digit and letter of the core by one drawn for its place."""
    digits = F.translate(hexes, "abcdef", "361908")
    lower = F.translate(hexes, "0123456789abcdef", "abdefghiklmnorst")
    return F.array_join(F.transform(F.split(core, ""), lambda c, i: F.when(
        c.rlike("[0-9]"), F.substring(digits, i % 128 + 1, F.lit(1))).when(
        c.rlike("[a-z]"), F.substring(lower, i % 128 + 1, F.lit(1))).when(
        c.rlike("[A-Z]"), F.upper(F.substring(lower, i % 128 + 1, F.lit(1)))).otherwise(c)), "")


def _checked(body):
    """A card number's digits with the check digit that makes them valid."""
    n = F.length(body)
    total = F.aggregate(F.transform(F.split(body, ""), lambda c, i: F.when(
        (n - i) % 2 == 1, F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))).otherwise(
        c.cast("int"))), F.lit(0), lambda a, x: a + x)
    return F.concat(body, F.pmod(F.lit(10) - total % 10, F.lit(10)).cast("string"))


def surrogate(kind, core, attempt, key: str):
    """A core's surrogate core at its nth draw."""
    hexes = F.sha2(F.concat_ws("|", F.lit(key), kind, core, attempt.cast("string")), 512)

    def number(at):
        return F.conv(F.substring(hexes, at, 4), 16, 10).cast("int")

    local = F.substring_index(core, "@", 1)
    tld = F.element_at(F.split(core, r"\."), -1)
    mail = F.concat(_drawn(F.rpad(local, 6, "x"), hexes), F.lit("@"),
                    F.translate(F.substring(hexes, 100, 6), "0123456789abcdef", "abdefghiklmnorst"),
                    F.lit(".example."), tld)
    syllable = F.array(*[F.lit(s) for s in _SYLLABLES])
    parts = [F.element_at(syllable, F.conv(F.substring(hexes, 9 + i, 1), 16, 10).cast("int") + 1) for i in range(5)]
    name = F.initcap(F.concat(*parts))
    cyrillic = F.translate(name, _LATIN, _CYRILLIC)
    octets = F.concat_ws(".", *[(number(1 + 4 * i) % 254 + 1).cast("string") for i in range(4)])
    digits = _drawn(core, hexes)
    card = _checked(F.concat(F.substring(core, 1, 1), F.expr("''"),
                             F.substring(digits, F.lit(2), F.greatest(F.lit(0), F.length(core) - 2))))
    return (F.when(kind == "email", mail).when(kind == "ip", octets).when(kind == "card", card)
            .when(kind == "name", F.when(core.rlike(r"\p{IsCyrillic}"), cyrillic).otherwise(name))
            .when(kind == "iban", F.concat(F.substring(core, 1, 2), F.substring(digits, F.lit(3), F.length(core))))
            .when(kind == FULL, _given(core, attempt, key))
            .otherwise(digits))


def _given(core, attempt, key):
    """A full name's (gender|given names|family name) surrogate (given names|family name), word by word."""
    fields = F.split(core, r"\|")
    gender = fields[0]

    def word(w, i):
        hexes = F.sha2(F.concat_ws("|", F.lit(key), F.lit(FULL), core, attempt.cast("string"), i.cast("string")), 256)
        draw = F.conv(F.substring(hexes, 1, 6), 16, 10).cast("int")
        cyrillic = w.rlike(r"\p{IsCyrillic}")

        def listed(names):
            lists = {g: F.array(*[F.lit(n) for n in names[g]]) for g in "mf"}
            lists["both"] = F.concat(lists["m"], lists["f"])
            return F.get(F.when(gender == "m", lists["m"]).when(gender == "f", lists["f"]).otherwise(lists["both"]),
                         draw % F.when(gender == "m", len(names["m"])).when(gender == "f", len(names["f"])).otherwise(
                             len(names["m"]) + len(names["f"])))

        made = F.initcap(F.concat(F.array_join(F.transform(
            F.sequence(F.lit(1), F.least(attempt + 1, F.lit(12))), lambda k: F.get(
                F.array(*[F.lit(s) for s in _SYLLABLES]),
                F.conv(F.substring(hexes, k + 8, F.lit(1)), 16, 10).cast("int"))), ""),
            F.when(gender == "m", "n").when(gender == "f", "la").otherwise("s")))
        # one turn of the alphabet for all initials of a family, so distinct ones stay distinct
        turn = F.pmod(F.xxhash64(F.lit(key), fields[2]), F.lit(25)).cast("int") + 1

        def turned(c):
            new = c
            for letters in _CAPITALS:
                at = F.instr(F.lit(letters), c)
                new = F.when(at > 0, F.substring(F.lit(letters), (at - 1 + turn) % len(letters) + 1, F.lit(1))
                             ).otherwise(new)
            return new

        initials = F.array_join(F.transform(F.split(w, ""), turned), "")
        return F.when(w.rlike(rf"^{_PARTICLE}$"), w).when(w.rlike(rf"^{_INITIAL}$"), initials).when(attempt == 0, F.when(cyrillic, listed(GIVEN_CYRILLIC)).otherwise(listed(GIVEN))).otherwise(
            F.when(cyrillic, F.translate(made, _LATIN, _CYRILLIC)).otherwise(made))

    return F.concat_ws("|", F.array_join(F.transform(F.split(fields[1], " "), word), " "), fields[2])


def _in_format(value, new):
    """The mention with its letters and digits replaced from the right by the new core's."""
    start = F.struct(F.lit("").alias("out"), new.alias("rest"))

    def step(acc, c):
        take = c.rlike("[0-9A-Za-z]") & (F.length(acc["rest"]) > 0)
        return F.struct(
            F.concat(F.when(take, F.right(acc["rest"], F.lit(1))).otherwise(c), acc["out"]).alias("out"),
            F.when(take, F.substring(acc["rest"], F.lit(1), F.length(acc["rest"]) - 1)).otherwise(
                acc["rest"]).alias("rest"))

    return F.aggregate(F.split(F.reverse(value), ""), start, step, lambda acc: acc["out"])


def _title(value):
    return F.regexp_extract(value, f"^{_TITLES}", 0)


def _words(value):
    return F.split(F.regexp_replace(value, f"^{_TITLES}", ""), " ")


def _given_words(words):
    return F.slice(words, F.lit(1), F.greatest(F.lit(0), F.size(words) - 1))


def full_of(value):
    """A name's core as a full name, null if it has no given name."""
    words, title = F.transform(_words(value), _folded), _title(value)
    gender = (F.when(title.rlike(rf"(?:^| )(?:{MALE})\.? "), "m").when(
        title.rlike(rf"(?:^| )(?:{FEMALE})\.? "), "f").otherwise("both"))
    given = F.array_join(_given_words(words), " ")
    return F.when(F.size(words) > 1, F.concat_ws("|", gender, given, F.element_at(words, -1)))


def _name(value, new, given):
    """Titles, the new given names if there were any, and the new family name, each in its old one's case."""
    words = _words(value)
    named = F.zip_with(_given_words(words), F.split(given, " "), lambda o, g: _cased(g, o))
    return F.concat(_title(value), F.concat_ws(" ", named, _cased(new, F.element_at(words, -1))))


def _phrases(value, new, given):
    """(phrase, rank, shown) that stand for a name without its title: the whole of it (rank 0),
    its family name alone or after a given name (1), and its given names (2); the first two
    also in capitals."""
    words = F.transform(_words(value), _folded)

    def phrase(text, rank, shown):
        return F.struct(text.alias("phrase"), F.lit(rank).alias("rank"), shown.alias("shown"))

    single = F.zip_with(_given_words(words), F.split(given, " "), lambda o, g: phrase(o, 2, g))
    single = F.filter(single, lambda p: p["phrase"].rlike(f"^{_CAPITAL}$"))
    family = F.element_at(words, -1)
    paired = F.transform(single, lambda p: phrase(F.concat_ws(" ", p["phrase"], family), 1,
                                                  F.concat_ws(" ", p["shown"], new)))
    none = F.array().cast("array<struct<phrase:string,rank:int,shown:string>>")
    named = F.concat(F.array(phrase(F.array_join(words, " "), 0, F.concat_ws(" ", given, new)),
                             phrase(family, 1, new)), F.coalesce(paired, none))
    loud = F.transform(named, lambda p: F.struct(F.upper(p["phrase"]).alias("phrase"), p["rank"].alias("rank"),
                                                 F.upper(p["shown"]).alias("shown")))
    # as written: words of mixed case (Mc, O') differ from their folded form
    asis = F.array(phrase(F.array_join(_words(value), " "), 0, F.concat_ws(" ", given, new)),
                   phrase(F.element_at(_words(value), -1), 1, new))
    asis = F.filter(asis, lambda p: F.upper(p["phrase"]) != p["phrase"])
    return F.concat(named, loud, asis, F.coalesce(single, none))


def _given_names(known):
    """(full, given): a full name after a title for both genders is the one with a gender, if there is one."""
    names = known.where(F.col("kind") == FULL).select(
        F.col("core").alias("full"), F.substring_index("core", "|", 1).alias("gender"),
        F.substring_index("core", "|", -2).alias("person"), F.substring_index("new", "|", 1).alias("given"))
    # "both" comes before "f" and "m"; the man's name if there are two
    sure = names.groupBy("person").agg(F.max_by("given", "gender").alias("sure"))
    return names.join(sure, "person").select(
        "full", F.when(F.col("gender") == "both", F.col("sure")).otherwise(F.col("given")).alias("given"))


def mapping(entities: DataFrame, key: str) -> DataFrame:
    """(kind, core, new) without collisions for distinct (kind, core)."""
    now = materialize(entities.withColumn("attempt", F.lit(0)).withColumn(
        "new", surrogate(F.col("kind"), F.col("core"), F.lit(0), key)))
    for _ in range(ROUNDS):
        first = now.groupBy("kind", "new").agg(F.min("core").alias("first"), F.count("*").alias("n"))
        taken = now.select("kind", F.col("core").alias("new"), F.lit(True).alias("taken"))
        clash = first.join(taken, ["kind", "new"], "left").where("n > 1 or taken").select(
            "kind", "new", F.when(F.col("taken"), None).otherwise(F.col("first")).alias("keeps"), F.lit(1).alias("clash"))
        marked = materialize(now.join(clash, ["kind", "new"], "left").withColumn(
            "again", F.col("clash").isNotNull() & ~F.coalesce(F.col("keeps") == F.col("core"), F.lit(False))))
        if marked.where("again").isEmpty():
            return marked.select("kind", "core", "new")
        attempt = F.col("attempt") + F.col("again").cast("int")
        now = materialize(marked.select(
            "kind", "core", attempt.alias("attempt"),
            F.when(F.col("again"), surrogate(F.col("kind"), F.col("core"), attempt, key)).otherwise(
                F.col("new")).alias("new")))
    raise RuntimeError("surrogates still collide; widen their kinds")


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """All columns with the text rewritten, and ``n_<kind>`` for each kind (columns of these
    names are replaced). ``key`` is the secret that the surrogates depend on."""
    counted = [f"n_{k}" for k in KINDS]
    docs = docs.drop(*counted)
    body = F.coalesce(F.col(text), F.lit(""))
    quiet = docs.where(~body.rlike(ANY)).select("*", *[F.lit(0).cast("long").alias(c) for c in counted])
    kept = [c for c in docs.columns if c != text]
    # written once: one scan finds the entities, and the row numbers stay what they are
    loud = materialize(docs.where(body.rlike(ANY)).select(
        F.monotonically_increasing_id().alias("row"), *[F.col(c).alias(f"kept_{i}") for i, c in enumerate(kept)],
        F.split(text, ANY, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)).alias("found")))
    parts = loud.select("row", F.posexplode("found").alias("nth", "value"))
    parts = parts.withColumn("kind", kind_of(F.col("value")))
    parts = parts.withColumn("core", core_of(F.col("kind"), F.col("value")))
    parts = parts.withColumn("full", F.when(F.col("kind") == "name", full_of(F.col("value"))))
    entities = parts.where("kind is not null").select(F.explode(F.filter(F.array(
        F.struct("kind", "core"), F.struct(F.lit(FULL).alias("kind"), F.col("full").alias("core"))),
        lambda e: e["core"].isNotNull())).alias("e")).select("e.*").distinct()
    known = mapping(entities, key)
    value, new = F.col("value"), F.col("new")
    shown = (F.when(new.isNull(), value).when(F.col("kind").isin("email", "ip"), new)
             .when(F.col("kind") == "name", _name(value, new, F.col("given"))).otherwise(_in_format(value, new)))
    # only mentions meet the entities, only full names the given names; the gaps are moved once, to their mentions
    given = _given_names(known)
    both = parts.where("full is null").withColumn("given", F.lit(None).cast("string")).unionByName(
        parts.where("full is not null").join(given, "full", "left"))
    phrases = F.when((F.col("kind") == "name") & new.isNotNull(), _phrases(value, new, F.col("given")))
    mentions = both.join(known, ["kind", "core"], "left").select(
        "row", "nth", "kind", shown.alias("shown"), phrases.alias("phrases"))
    by_row = mentions.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("nth", "shown"))).alias("mentions"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("phrases")))).alias("phrases"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS])
    # of a phrase with several meanings the first by rank; longer phrases are tried first
    first = by_row.withColumn("phrases", F.filter("phrases", lambda p, i: (i == 0) | (
        p["phrase"] != F.get("phrases", i - 1)["phrase"])))
    longest = F.reverse(F.array_sort(F.transform("phrases", lambda p: F.struct(F.length(p["phrase"]), p["phrase"]))))
    own = F.when(F.size("phrases") > 0, F.concat(
        F.lit(r"(?<![\p{L}\p{M}])(?:"),
        F.array_join(F.transform(longest, lambda p: F.concat(F.lit(r"\Q"), p["phrase"], F.lit(r"\E"))), "|"),
        F.lit(r")(?![\p{L}\p{M}])")))
    first = first.withColumn("own", own).withColumn("of", F.map_from_arrays("phrases.phrase", "phrases.shown"))

    def untitled(gap):
        found = F.regexp_extract_all(gap, F.col("own"), F.lit(0))
        return F.when(F.col("own").isNull(), gap).otherwise(F.array_join(F.flatten(F.transform(
            F.split(gap, F.col("own"), -1), lambda g, i: F.array(
                g, F.coalesce(F.element_at("of", F.get(found, i)), F.lit(""))))), ""))

    whole = F.array_join(F.flatten(F.transform("gaps", lambda g, i: F.array(
        untitled(g), F.coalesce(F.get("mentions", i)["shown"], F.lit(""))))), "")
    more = F.when(F.col("own").isNull(), F.lit(0)).otherwise(F.aggregate(
        "gaps", F.lit(0), lambda a, g: a + F.size(F.regexp_extract_all(g, F.col("own"), F.lit(0)))))
    back = {c: F.col(f"kept_{i}") for i, c in enumerate(kept)} | {text: whole}
    done = loud.join(first, "row").withColumn("n_name", F.col("n_name") + more).select(*[back[c].alias(c) for c in docs.columns], *counted)
    return quiet.unionByName(done)
