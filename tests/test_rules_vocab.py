"""Rule-text vocabulary (Q6, Q14) and the generated rule texts."""

from lakesmith.functions import vocab
from lakesmith.operators import rules


def test_every_generated_bronze_text_is_recognised():
    assert vocab.bronze_cast(rules.BRONZE_INT.lower()) == "integer"
    assert vocab.bronze_cast(rules.BRONZE_FLOAT.lower()) == "float"
    assert vocab.bronze_cast(rules.BRONZE_DATE.lower()) == "date"
    assert vocab.bronze_cast(rules.BRONZE_TEXT.lower()) == "text"


def test_every_generated_silver_text_is_recognised():
    ident = vocab.silver_ops(rules.SILVER_ID.lower())
    assert ident.cast == "text" and ident.nulls is None
    date = vocab.silver_ops(rules.SILVER_DATE.lower())
    assert (date.nulls, date.cast) == ("mode", "date")
    num = vocab.silver_ops(rules.SILVER_NUMERIC.lower())
    assert (num.nulls, num.cast) == ("mean", "float")
    txt = vocab.silver_ops(rules.SILVER_TEXT.lower())
    assert (txt.nulls, txt.cast, txt.strip) == ("mode", "text", True)
    assert vocab.silver_ops(rules.DEDUP_TEXT.format("id").lower()).dedup


def test_substring_traps_do_not_fire():
    # "updated", "context", "account", "assume", "administer", "stripe", "alphanumeric"
    assert vocab.bronze_cast("keep the updated value") is None
    assert vocab.silver_ops("use context").cast is None
    assert vocab.gold_agg("per account") is None
    assert vocab.gold_agg("assume nothing") is None
    assert vocab.gold_agg("administer") is None
    assert not vocab.silver_ops("stripe pattern").strip
    assert vocab.silver_ops("alphanumeric").cast is None


def test_gold_aggregate_precedence():
    assert vocab.gold_agg("sum of amount") == "sum"
    assert vocab.gold_agg("summed total") == "sum"
    assert vocab.gold_agg("average price") == "avg"
    assert vocab.gold_agg("mean price") == "avg"
    assert vocab.gold_agg("count of orders") == "count"
    assert vocab.gold_agg("maximum discount") == "max"
    assert vocab.gold_agg("min tax") == "min"


def test_unrecognised_rules_are_reported():
    assert vocab.rule_status("silver", "x", "do something clever") == "unrecognised"
    assert vocab.rule_status("bronze", "_load_timestamp", "anything") == "recognised"
    assert vocab.rule_status("gold", "x", "passthrough") == "recognised"
