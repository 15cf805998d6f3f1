import pytest

from caseloom.functions import text as x


def test_dedup_key(values):
    assert values(x.reply_dedup_key, "string", "Hi  THERE https://t.co/Ab c", "A \n b") == \
        ["hi there <link> c", "a b"]


def test_dedup_key_can_drop_handles(values):
    assert values(lambda c: x.reply_dedup_key(c, True), "string", "@1 DM us", "@2 @3 DM  us", "mail @4 me") == \
        ["dm us", "dm us", "mail @4 me"]


def test_dm_redirect(values):
    got = values(x.flag_dm_redirect, "string", "Please DM", None, "Join us in DM", "please respond in DM",
                 "Contact our Account Security team", "contact our\nteam", "Kindly DM US now", "admire us")
    assert got == [True, False, False, False, True, False, True, False]


def test_patterns_are_joined_without_changing_what_they_match(values):
    assert x.any_of([r"\ba|b", r"\bc"]) == r"\ba|b|\bc"
    assert x.any_of([r"\b(a|b)\b", r"\bc"]) == r"\b(?:(a|b)\b|c)"


def test_no_dm(values):
    assert values(x.no_dm_preference, "string", "No need to DM me", "I dont want to dm", "I don't need to DM",
                  "without dm", "dm me", None) == [True, True, True, True, False, False]


def test_mojibake(values):
    got = values(x.repair_mojibake, "string", "itâ€™s cafÃ©", "café", "日本", None,
                 "日本 itâ€™s", "\U0001f600 cafÃ©", "naïve Ã©")
    assert got == ["it’s café", "café", "日本", None, "日本 it’s",
                   "\U0001f600 café", "naïve Ã©"]


def damage(text, *pages):
    for page in pages:
        text = "".join(bytes([b]).decode(page, "ignore") or chr(b) for b in text.encode())
    return text


@pytest.mark.parametrize("pages", [("cp1252",), ("latin-1",), ("cp1250",), ("cp1252", "cp1252"), ("latin-1", "latin-1"), ("cp1250", "cp1250"),
                                   ("cp1252", "latin-1"), ("latin-1", "cp1252"), ("cp1252",) * 3])
def test_pages_and_layers_of_damage(values, pages):
    texts = ["it’s café", "žluťoučký kůň", "Größe – naïve", "¿Qué? ¡Sí!", "日本語 text", "\U0001f600 ok", "plain", "“quoted” … 5 €"]
    got = values(x.repair_mojibake, "string", *[damage(t, *pages) for t in texts])
    assert got == texts


def test_sound_texts_stay(values):
    texts = ["Ångström Ärger Łódź", "São Tomé", "ÎÏ ÀÉ", "Â", "Ã", "x² ± 5°", "", None, "naïve Ã©", "«Á»", "a" * 5_000]
    assert values(x.repair_mojibake, "string", *texts) == texts


def test_clean_text(spark):
    texts = ["we\u2019ll \u201cgo\u201d", "it\u00e2\u20ac\u2122s", "R&amp;D", "<b>&amp;</b>", "a\r\nb\rc\u2028d", None, "&amp;lt;"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    assert [r.c for r in x.clean_text(df, "c").orderBy("i").collect()] == \
        ["we'll \"go\"", "it's", "R&D", "<b>&amp;</b>", "a\nb\nc\nd", None, "&lt;"]


def test_strip_is_unicode(values):
    assert values(x.strip, "string", "  \n x y \t", "\x1fa\x85") == ["x y", "a"]


def test_malformed(values):
    got = values(x.reply_is_malformed, "string", None, "", "Too short.", "This one has no ending",
                 "See this page https://x.y/z", "This one has an ending.  \n", "It’s what they call ‘it’")
    assert got == [True, True, True, True, False, False, False]


def test_fence(values):
    assert values(x.strip_code_fence, "string", "```json\n{\"a\": 1}\n```", "{\"a\": 1}", "```\n[1]\n```\n", " x ") == \
        ["{\"a\": 1}", "{\"a\": 1}", "[1]", "x"]


def test_invisible_and_fallback(values):
    assert values(x.strip_invisible, "string", "\ufeff a\u200bb\u200c \u200d") == ["ab"]
    assert values(x.fallback_text, "string", None, "", "x") == [
        "[reply generation failed -- flagged for manual drafting]"] * 2 + ["x"]


def test_truncation_counts_code_points(values):
    assert values(lambda c: x.truncate_text(c, 2), "string", "\U0001f600\U0001f601\U0001f602", "a") == \
        ["\U0001f600\U0001f601", "a"]


def test_prompt_and_key(values):
    import hashlib

    assert values(x.numbered_prompt, "array<string>", ["a", "b"], []) == ["1. a\n2. b", ""]
    assert values(x.format_examples, "array<string>", ["a", "b"]) == ["a\n\nb"]
    assert values(lambda c: x.request_key(c, c), "string", "x") == [hashlib.sha256(b"x|x").hexdigest()]


def test_limit(values):
    assert values(x.over_limit, "string", "a" * 280, "a" * 281, None) == [False, True, False]


def test_no_pattern_lists_a_character_at_a_time():
    """Java tests the parts of a class in turn, for every character of a text."""
    assert x._class("abcdxz") == r"\x{61}-\x{64}\x{78}\x{7a}" and x._class("a") == r"\x{61}"


def test_runs_beside_other_scripts(values):
    """A run that the page holds is repaired, whatever stands beside it; ASCII alone and empty texts stay."""
    texts = ["日本 " + damage("é ü", "cp1252") + " 日本 " + damage("ö", "cp1252"), "", "a\n\x00\x7f", "Ã\x81 日"]
    assert values(x.repair_mojibake, "string", *texts) == ["日本 é ü 日本 ö", "", "a\n\x00\x7f", "Á 日"]
