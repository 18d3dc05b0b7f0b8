"""Secret scans: the query's base columns against plain patterns, pairs on made-up sources, long and odd texts."""

import hashlib
import re
import time

import pytest
from pyspark.sql import functions as F

from snapquarry.llm import secrets
from snapquarry.llm.common import table

KEY = "Zx9qLm72Kd"


def found(text):
    return [text[a:b] for a, b in secrets.pairs(text)]


def base(text):
    """The base kinds as the contract words them: leftmost, non-overlapping, failing ones dropped after."""
    patterns = [("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24)]
    return sorted((m.start(), k, m.end()) for k, (_, p, g, least) in enumerate(patterns) for m in re.finditer(p, text) if len(m[g]) >= least)


def test_query_against_patterns(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    got = secrets.op3_secrets(spark, sf_dir).collect()
    assert len(got) == len(texts) and sum(r.n_assign + r.n_access + r.n_hex for r in got) > 0
    for r in got:
        want = base(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x[1] for x in want) for k in range(3)]
        listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in want)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) - {""} <= set(r.spans.split(","))
        pairs = [x for x in r.spans.split(",") if x.startswith("pair")]
        assert pairs == [f"pair:{a}:{b}" for a, b in secrets.pairs(texts[r.doc_id])] and len(pairs) == r.n_pair


@pytest.mark.parametrize("text", ["auth = request.headers", "access_key = config.get_value", "client_key = self.settings", "primary key: customer_identifier", 'author_key = "John Smith wrote"', 'token_type = "Bearer-Type2x"', 'secret: "Never give up today"', "key = value", f'if (token == "{KEY}") {{', f'user = "{KEY}"', "It's a key: don't lose it.", 'password_file = "/etc/x9/Secrets.d"'])
def test_not_secrets(text):
    assert found(text) == []


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('password = "a\\"b9Zx\\\\c"', ['a\\"b9Zx\\\\c']),
        ('signing_key = """Zx9qLm\n72Kd77"""', ["Zx9qLm\n72Kd77"]),
        (f"auth:\n  key: {KEY}\n  user: bob_smith9", [KEY]),
        (f'{{"auth": {{"key": "{KEY}"}}, "key9": "x", "x": "{KEY}"}}', [KEY]),
        ('secrets:\n  stripe: "sk_live_9aB3"\nother:\n  stripe: "sk_live_9aB4"', ["sk_live_9aB3"]),
        ('password: str = "Hunter22x!"', ["Hunter22x!"]),
        (f'os.environ["API_TOKEN"] = "{KEY}"', [KEY]),
        ('conf.put("Authorization", "Bearer9x72Kd")', ["Bearer9x72Kd"]),
        ('client.set_password("Hunter22x!")', ["Hunter22x!"]),
        ("<password>Hunter22x!</password>", ["Hunter22x!"]),
        (f'base = "{KEY}"\nauth_token = base', [KEY]),
        (f'class C:\n    K = "{KEY}"\nauth_token = C.K', []),
        (f'C.K = "{KEY}"\nauth_token = C.K', [KEY]),
        (f'def f():\n    k = "{KEY}"\n\ndef g():\n    auth_token = k\n', []),
        (f'k = "Aa11Bb22Cc"\ndef f():\n    k = "{KEY}"\n    auth_token = k\n', [KEY]),
        (f'int f() {{ k = "{KEY}"; }} int g() {{ auth_token = k; }}', []),
        (f"- name: DB_PASSWORD\n  value: {KEY}\n- name: USER\n  value: Zx9qLm72Ke", [KEY]),
        (f"private_key: |\n  MIIEvQ9aB3\n  {KEY}\nother: 1", [f"MIIEvQ9aB3\n  {KEY}"]),
        ('auth_token = ("Zx9q"\n   "Lm72Kd")', ["Zx9q", "Lm72Kd"]),
        ('auth_token = "Zx9q" + other + "Lm72Kd"', ["Zx9q", "Lm72Kd"]),
        ('password = b64decode("c2VjcmV0MTI=")', ["c2VjcmV0MTI="]),
        (f'"apiKey" => "{KEY}",', [KEY]),
        ('connect(user="bob", password="Hunter22x!")', ["Hunter22x!"]),
        ("API_TOKEN=Zx9q/Lm72+Kd==", ["Zx9q/Lm72+Kd=="]),
        ("password = 'correct horse battery staple'", ["correct horse battery staple"]),
    ],
)
def test_pairs(text, want):
    assert found(text) == want


def test_literal_of_a_megabyte():
    long = "aB3+xY7q" * 130_000
    for text in (f'x_auth = "{long}"', f"password = '''{long}'''", f'"secret": "{long}"'):
        assert found(text) == [long]


@pytest.mark.parametrize("text", ['password "' + '\\"' * 300_000, "password = '" * 50_000, "' " * 200_000 + "password", "a." * 300_000 + " password", "{" * 300_000 + "password", "password:\n" * 60_000, "<a>" * 150_000 + "password", "password: a " * 50_000, "password = " + "a + " * 100_000, "{a=b" * 60_000 + "password", "password: |\n" + " x\n" * 100_000, "password(" * 60_000, 'password = """' * 50_001], ids=range(13))
def test_long_texts_take_linear_time(text):
    began = time.process_time()
    secrets.spans(text)
    assert time.process_time() - began < 8


def test_stage_keeps_null_texts_and_other_columns(spark, sf_dir):
    import corpus_pipeline

    rows = [(1, None, "en", "s", 7, "x"), (2, "", None, None, None, "x"), (3, f'é auth_key = "{KEY}" end', "fr", "s", 1, None), (3, "plain", "fr", "s", 5, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, spans string")
    out = corpus_pipeline.secret_stage(spark, df, sf_dir)
    assert out.columns == df.columns
    got = sorted(out.collect(), key=lambda r: (r.doc_id, r.text or ""))
    assert got[0].text is None and got[0].n_chars == 7 and got[1].text == ""
    assert [(r.text, r.n_chars) for r in got[2:]] == [("plain", 5), ('é auth_key = "<secret>" end', 27)]
    assert corpus_pipeline.secret_stage(spark, df.filter(F.lit(False)), sf_dir).count() == 0


LONE = "Zx91kQmP0vTe7"


@pytest.mark.parametrize(
    "text",
    [
        f'setPassword("{LONE}")', f'define("AUTH_KEY", "{LONE}")', f"put('api_token', '{LONE}')", f"<config><password>{LONE}</password></config>", f"<password>{LONE}</password>", f'conn.with_secret("{LONE}")', f'db_pass = "{LONE}"', f'f(password="{LONE}")', f'"dbPass": "{LONE}"', f"client_secret: {LONE}",
        f'env["API_TOKEN"] = "{LONE}"', f'"passwd" => "{LONE}"', f'secret := "{LONE}"', f'key_token: str = "{LONE}"', f"set_passphrase('{LONE}')", f"- name: DB_PASSWORD\n  value: {LONE}", f"auth_token: |\n  {LONE}\n",
    ],
)
def test_each_form_alone(text):
    """Each form with nothing else in the text: it is a span, and the redacted text has it no more."""
    spans = secrets.spans(text)
    assert any(k == 3 and text[a:b] == LONE for a, k, b in spans), spans
    assert LONE not in secrets.redacted(text, spans)


@pytest.mark.parametrize("text", [f'setTitle("{LONE}")', f'define("COLOUR", "{LONE}")', f"<config><title>{LONE}</title></config>", f'bypass = "{LONE}"', f'pass_count = "{LONE}"', "passages (of the text) pass by"])
def test_forms_that_name_no_secret(text):
    assert secrets.pairs(text) == []


def test_pipeline_redacts_lone_forms(spark):
    import corpus_pipeline

    texts = [f'setPassword("{LONE}")', f'define("AUTH_KEY", "{LONE}")', f"<config><password>{LONE}</password></config>", None, "clean (text)"]
    df = spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r.doc_id: r.text for r in corpus_pipeline.secret_stage(spark, df, "").collect()}
    assert got[0] == 'setPassword("<secret>")' and got[1] == 'define("AUTH_KEY", "<secret>")' and got[2] == "<config><password><secret></password></config>" and got[3] is None and got[4] == "clean (text)"
