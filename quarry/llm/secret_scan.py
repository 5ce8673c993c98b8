"""Secret scan: candidates by a pattern, false positives removed by a random forest."""

from __future__ import annotations

import random
import string

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What stands before a secret, before something that only looks like one, and in made-up values.
SECRET_WORDS = "token|secret|passw|pwd|api.?key|apikey|access.?key|auth|bearer|credential|private.?key|client.?id|signature"
OTHER_WORDS = "commit|sha|hash|md5|checksum|digest|uuid|guid|revision|build|version|etag|isbn|order|invoice|serial|model|ref"
FAKE_WORDS = "example|sample|dummy|test|fake|placeholder|changeme|your|xxxx|redacted|insert|demo|todo"
#: What looks back needs a bound: how long a name may go on after its secret word, how long a URL's user name may be, and
#: how far before a candidate a word is its neighbour.
NAME, USER, NEAR = 100, 200, 24
#: A value in quotes, and one without, which ends before the next name of a list and before closing punctuation.
_QUOTED = "|".join(rf"(?<={q})[^\s{q}]{{4,}}(?<!\\)(?=\\?{q})" for q in "\"'`")
_PLAIN = r"""(?=[^\s"'`]{4})(?![=>:])[^\s"'`<>,;&]+(?:[,;&](?![\w.-]{0,40}[=:]|\s|$)[^\s"'`<>,;&]+){0,32}(?<![.,;:)\]}])"""
#: What stands before an assigned value: a secret word, the rest of its name and a sign. The first part, which is cheap, spares the second.
_ASSIGNED = (
    r"""(?<=[=:>][ \t]{0,4}\\?["'`]?)"""
    rf"""(?<=(?i:{SECRET_WORDS})[\w.-]{{0,{NAME}}}\\?["'`]?\]?[ \t]{{0,4}}(?::=|=>|={{1,3}}|:)[ \t]{{0,4}}\\?["'`]?)"""
)
#: Values of at least 4 characters assigned to a secret word, after "Bearer" or in a URL's user part (the password, or a user
#: alone), and runs of at least 16 characters of keys anywhere.
CANDIDATE = "|".join(
    [
        rf"""(?:{_ASSIGNED}|(?<=[ \t]["'`]?)(?<=(?i:bearer)[ \t]{{1,4}}["'`]?))(?!\w{{1,20}}://)(?:{_QUOTED}|{_PLAIN})""",
        rf"""(?<=:)(?<=://[^\s/:@"'`]{{0,{USER}}}:)[^\s/@"'`]{{4,}}(?=@)""",
        r"""(?<=://)[^\s/:@"'`]{4,}(?=@)""",
        r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}",
    ]
)
#: Frequent English words of keys, names and paths, of at least four letters.
DICTIONARY = """
about access account action active admin album alert amount android angular answer apple archive article asset audio author avatar
back backup banner base batch blog board book border bottom branch browser bucket build button cache calendar call camera card cart
case category center change channel chart chat check child class clean click client clock close cloud code color column comment commit
common company component config connect console contact container content control cookie copy core count country cover create custom
daily dark dash data date debug default delete demo deploy design desk detail develop device dialog digital direct disk display doc
document domain down download draft drive edit editor email empty engine entry error event example export extra face factory feature
feed field file filter final find first flag flow folder font food foot form forum frame free friend front full function game gallery
general getting global gold grand green group guide hand handler hash head header health heart help hidden high history holder home
host hour house icon image import index info inner input inside install int item java join journal jump just keep kernel key keyboard
label land language large last latest layer layout left legal level library license light limit line link list live load local lock
logic login logo long lookup main make manager map mark market master match media member menu message meta method middle mobile mode
model module money month more mount move movie music name native nav network never news next night node note number object office
offer online open option order origin other output over owner pack package page paper parent parse part pass password path pattern
people phone photo picture place plan play player plugin point policy pool popup port post power preview price print private process
product profile program project proof public query queue quick random range rate read real record refresh region register release
remote render repeat report request reset resource response rest result return review right river road role room root round route row
rule safe sample save scale scene schedule school score screen script search section secure select server service session setting
shape share ship shop short show side sign simple single site size slide small social software sort sound source space special spring
stack standard star start state static station status step stock storage store story stream street string strong student style submit
summer super support swift switch system table target task team temp template test text theme thread thumb ticket time title token
tool topic total touch track trade train transfer travel tree true type unit update upload user util value vector version video view
visit voice wait wall watch water wave weather week west white widget width window winter wood word work world write year young zone
"""

FEATURES = [
    "length", "distinct", "entropy", "digits", "uppers", "lowers", "symbols", "hex", "transitions", "vowel_pairs", "covered", "run",
    "ordered", "padded", "path_in", "path_before", "quoted", "assigned", "secret_before", "other_before", "fake_near", "fake_in",
    "punctuated", "user_part",
]


def features(c: Column, before: Column, after: Column) -> dict[str, Column]:
    """Of a candidate and what stands before and after it: length, character transitions, dictionary coverage, path, neighbouring words."""
    n = F.length(c).cast("double")
    share = lambda pattern, of=c: F.regexp_count(of, F.lit(pattern)) / n
    chars = F.array_distinct(F.split(c, ""))
    entropy = F.aggregate(
        chars,
        F.lit(0.0),
        lambda a, x: a - F.when(x == "", 0.0).otherwise(
            ((n - F.length(F.replace(c, x, F.lit("")))) / n) * F.log2(F.greatest(F.lit(1e-9), (n - F.length(F.replace(c, x, F.lit("")))) / n))
        ),
    )
    low = F.lower(c)
    words = "|".join(sorted((w for w in DICTIONARY.split() if len(w) > 3), key=lambda w: (-len(w), w)))
    yes = lambda x: F.coalesce(x.cast("double"), F.lit(0.0))
    return {
        "length": n,
        "distinct": F.size(chars) / n,
        "entropy": entropy,
        "digits": share("[0-9]"),
        "uppers": share("[A-Z]"),
        "lowers": share("[a-z]"),
        "symbols": share("[+/_=-]"),
        "hex": yes(c.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
        "transitions": share("[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])"),
        "vowel_pairs": share("[aeiou][b-df-hj-np-tv-z]", low),
        "covered": 1 - F.length(F.regexp_replace(low, words, "")) / n,
        "run": yes(c.rlike(r"(.)\1{3}")),
        "ordered": yes(low.rlike("0123|1234|2345|3456|abcd|bcde|qwer")),
        "padded": yes(c.endswith("=")),
        "path_in": F.regexp_count(c, F.lit("/")) / n,
        "path_before": yes(before.rlike(r"(?:https?:|www\.|[a-z]/|\.\w{1,4}[/?]|[\\/#?&.:])\S*$")),
        "quoted": yes(before.rlike("[\"'`]$")),
        "assigned": yes(before.rlike("(?:=|:|=>|:=)\\s*[\"'`]?$")),
        "secret_before": yes(before.rlike(f"(?i)(?:{SECRET_WORDS})[^\\n]{{0,{NEAR}}}$")),
        "other_before": yes(before.rlike(f"(?i)\\b(?:{OTHER_WORDS})[^\\n]{{0,{NEAR}}}$")),
        "fake_near": yes(before.rlike(f"(?i){FAKE_WORDS}")) + yes(after.rlike(f"(?i){FAKE_WORDS}")),
        "fake_in": yes(low.rlike(FAKE_WORDS)),
        "punctuated": share("[^A-Za-z0-9+/_=-]"),
        "user_part": yes(before.rlike("://[^\\s/:@]*:$")) + yes(before.rlike("://[^\\s/@]*$") & after.startswith("@")),
    }


def labelled_findings(spark: SparkSession, rows: int = 4000, seed: int = 3) -> DataFrame:
    """Labelled findings (before, candidate, after, secret), made by rules with a seed.

    Half are secrets: random keys of usual alphabets and prefixes after words and signs that
    introduce them, with or without digits, shorter ones and punctuated passwords after such words,
    and passwords of URLs. Half look alike: commit and content hashes, paths, identifiers made of
    words, made-up values, number series, keys said to be examples, long words, and words, numbers
    and code after secret words.
    """
    r = random.Random(seed)
    alphabets = ["0123456789abcdef", "0123456789ABCDEF", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "_-", string.ascii_uppercase + string.digits, string.ascii_letters, string.ascii_uppercase]
    names = DICTIONARY.split()
    prose = lambda: " ".join(r.choice(names) for _ in range(r.randint(0, 6)))
    key = lambda n=None, a=None: "".join(r.choice(a or alphabets[0]) for _ in range(n or r.choice((20, 24, 32, 40, 40, 48, 64))))

    def password() -> str:
        if r.random() < 0.4:
            word = r.choice(names).translate(str.maketrans("aeio", r.choice(("aeio", "4310", "@e!0"))))
            return f"{word.title()}{r.choice('!#$%&*?@.')}{r.randint(1, 9999)}{r.choice(('', '!', '?', '#'))}"
        while True:
            x = key(r.randint(8, 15), string.ascii_letters + string.digits + r.choice(("", "!#$%&*?@.+", "!#$%^&*()~|")))
            # a plain value ends before these
            if x[-1] not in ").&" and x[0] not in "&":
                return x

    def secret() -> tuple[str, str, str]:
        quote = r.choice(['"', '"', "'", ""])
        name = r.choice(["token", "token", "secret", "api_key", "apikey", "API_KEY", "password", "passwd", "access_key", "SECRET_KEY", "auth_token", "client_secret", "Bearer", "Authorization: Bearer", "private_key", "credentials"])
        kind = r.randrange(10)
        if kind == 0:
            user = r.choice([*names, "root", "postgres", "sa"])
            value = password().replace("@", "")
            return f"{prose()} {r.choice(['DATABASE_URL=', '', 'url: ', quote])}{r.choice(['postgres', 'mysql', 'amqp', 'redis', 'https', 'mongodb+srv', 'ftp'])}://{r.choice([user, user, ''])}:", value + "7" * (4 - len(value)), f"@{r.choice(names)}.{r.choice(names)}/{r.choice(names)}"
        sign = " " if name.endswith("Bearer") else r.choice([" = ", "=", ": ", ":", " := ", " => "])
        if kind < 3:
            value = password() if r.random() < 0.6 else key(r.choice((10, 12, 12, 14)), r.choice(alphabets[:6]))
            return f"{prose()} {name}{sign}{quote}", value, f"{quote} {prose()}"
        head = r.choice(["", "", "", "", "sk_live_", "ghp_", "AKIA", "xoxb-", "glpat-", "AIza"])
        bare = r.random() < 0.08 and head
        text = head + key(a=r.choice(alphabets)) + r.choice(["", "", "", "=", "=="])
        return f"{prose()} " if bare else f"{prose()} {name}{sign}{quote}", text, f"{quote} {prose()}"

    def other() -> tuple[str, str, str]:
        kind = r.randrange(10)
        some = lambda n: r.choice(["", str(n), str(n)])
        if kind == 0:
            return f"{prose()} {r.choice(['commit ', 'sha256:', 'sha1 ', 'md5 = ', 'checksum: ', 'digest ', 'revision ', 'etag: '])}", key(r.choice((32, 40, 64))), f" {prose()}"
        if kind == 1:
            return f"{prose()} {r.choice(['https://', 'http://www.', 'see ', '/', './', ''])}", "/".join([*(r.choice(names) for _ in range(r.randint(2, 5))), f"{r.choice(names)}{some(r.randint(1, 999))}"]), r.choice([".html ", ".png ", " ", "?id=2 "]) + prose()
        if kind == 2:
            return f"{prose()} {r.choice(['', 'id = ', 'name: ', '#', 'class=', 'key: '])}", r.choice("_-").join([*(r.choice(names) for _ in range(r.randint(2, 5))), *filter(None, [some(r.randint(1, 9999))])]), f" {prose()}"
        if kind == 3:
            return f"{prose()} {r.choice(['token = ', 'api_key: ', 'secret=', 'password = '])}{r.choice(['', chr(34)])}", r.choice(["your_api_key_goes_here_1", "x" * r.randint(15, 40) + "1", "example_token_" + key(8), "changeme1234567890", "0123456789abcdef" * r.randint(1, 3), "1234567890" * r.randint(2, 4), "test_" + key(16), "0" * r.randint(16, 40), "dummy-secret-value-" + str(r.randint(1, 99))]), f" {prose()}"
        if kind == 4:
            return f"{prose()} {r.choice(['order ', 'invoice no. ', 'isbn ', 'serial ', 'ref ', 'call ', ''])}", "".join(r.choice("0123456789") for _ in range(r.randint(16, 24))), f" {prose()}"
        if kind == 5:
            return f"{prose()} {r.choice(['uuid ', 'guid: ', 'id ', ''])}", "-".join(key(n) for n in (8, 4, 4, 4, 12)), f" {prose()}"
        if kind == 6:
            return f"{prose()} ", "".join(r.choice(names).title() for _ in range(r.randint(3, 5))) + some(r.randint(1, 99)), f" {prose()}"
        if kind == 7:
            sounds = [c + v + e for c in "bcdfghlmnprstvw" for v in "aeiou" for e in ("", "n", "r", "s", "ng", "tion")]
            word = "".join(r.choice(sounds) for _ in range(r.randint(6, 12)))
            word = r.choice((str.lower, str.lower, str.title, str.upper))(word + "ung" * (len(word) < 16))
            return r.choice([f"{prose()} ", f"{prose()} the ", f"{prose()} token of "]), word, f" {prose()}"
        if kind == 8:
            return f"{prose()} {r.choice(['https', 'ssh', 'ftp', 'git'])}://", r.choice(["user", "anonymous", "guest", r.choice(names)]), f"@{r.choice(names)}.{r.choice(names)}/{r.choice(names)}"
        a, b = r.choice(names), r.choice(names)
        value = r.choice([a, a, a.title(), f"{a}_{b}", f"{a}-{b}", f"{a}.{b}", f"{a}.{b}()", f"get_{a}()", f"{a.title()}{b.title()}", f"${{{a.upper()}_{b.upper()}}}", f"${a.upper()}", f"{a}[{b}]", "true", "false", "None", "null", "required", "string", "self.token", "********", str(r.randint(1000, 999999))])
        value = f"{value}{b}" if len(value) < 4 else value
        name = r.choice(["token", "secret", "api_key", "password", "passwd", "auth", "Author", "Authorization", "credentials", "signature", "client_id", "tokenizer", "Bearer"])
        return f"{prose()} {name}{r.choice([' = ', '=', ': ', ':'])}{r.choice(['', '', chr(34)])}", value, f" {prose()}"

    data = [(*(secret() if i % 2 else other()), i % 2) for i in range(rows)]
    return spark.createDataFrame(data, "before string, candidate string, after string, secret int")


def assembled(df: DataFrame) -> DataFrame:
    """df, with before, candidate and after, plus the vector `features`."""
    with_features = df.select("*", *(c.cast("double").alias(f"f_{k}") for k, c in features(F.col("candidate"), F.col("before"), F.col("after")).items()))
    return VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features").transform(with_features)


def train(findings: DataFrame, trees: int = 40, depth: int = 10, seed: int = 1) -> RandomForestClassificationModel:
    """A random forest over a bounded table of labelled findings."""
    data = assembled(findings).withColumn("label", F.col("secret").cast("double"))
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, maxMemoryInMB=64).fit(data)


def scan_secrets(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    model: RandomForestClassificationModel | None = None,
    least: float = 0.5,
    left: int = 60,
    right: int = 40,
) -> DataFrame:
    """The candidates of each row of docs, in order, with the forest's judgement.

    Every match of CANDIDATE in the whole text is a candidate; `left` and `right` characters around it,
    neighbouring candidates among them, give its context. score is the forest's probability of a
    secret, is_secret whether it is at least `least`. The result has doc_id, nth (from 0), start and
    length in characters, secret_sha256 (never the candidate itself), score and is_secret.

    Never a candidate: fewer than 4 characters, and of fewer than 16 what stands neither after a secret
    word, up to NAME characters more of its name and a sign, nor after "Bearer", nor in a URL's user part
    (user names of up to USER characters). A value without quotes ends at its 33rd comma, semicolon or &. The labelled findings that the
    model is trained on by default are made up (see labelled_findings()); where findings of one's own
    are at hand, train() takes them.

    Null and empty texts have no candidates. Null doc_ids and repeated rows are scanned like others.
    An empty table gives an empty table. Other columns, whatever their names, are ignored. The model
    defaults to one trained on labelled_findings().
    """
    model = model or train(labelled_findings(docs.sparkSession))
    hits = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.col("text").rlike(CANDIDATE))
    parts = hits.select(
        "doc_id",
        F.monotonically_increasing_id().alias("rid"),
        F.split("text", CANDIDATE, -1).alias("gaps"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"),
    )
    each = parts.select(
        "doc_id",
        "rid",
        F.posexplode(
            F.transform(
                "found",
                lambda c, i: F.struct(
                    c.alias("candidate"),
                    F.right(F.get("gaps", i), F.lit(left)).alias("gap_before"),
                    F.left(F.get("gaps", i + 1), F.lit(right)).alias("gap_after"),
                    F.length(F.get("gaps", i)).alias("gap"),
                ),
            )
        ).alias("nth", "c"),
    ).select("doc_id", "rid", "nth", "c.*")
    order = Window.partitionBy("rid").orderBy("nth")
    so_far = F.sum(F.col("gap") + F.length("candidate")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # a neighbour has a character at least, so as many rows as characters reach far enough
    earlier = F.collect_list(F.concat("gap_before", "candidate")).over(order.rowsBetween(-left, -1))
    later = F.collect_list(F.concat("candidate", "gap_after")).over(order.rowsBetween(1, right))
    placed = each.withColumns(
        {
            "start": (so_far - F.length("candidate")).cast("long"),
            "before": F.right(F.concat(F.array_join(earlier, ""), "gap_before"), F.lit(left)),
            "after": F.left(F.concat("gap_after", F.array_join(later, "")), F.lit(right)),
        }
    )
    judged = model.transform(assembled(placed))
    score = F.round(F.element_at(vector_to_array("probability"), 2), 6)
    return judged.select(
        "doc_id",
        F.col("nth").cast("long").alias("nth"),
        "start",
        F.length("candidate").cast("long").alias("length"),
        F.sha2("candidate", 256).alias("secret_sha256"),
        score.alias("score"),
        (score >= least).alias("is_secret"),
    )
