from plan_text import plan_of
from pyspark.sql import functions as F

from trolley.operators import accepted, activity_rules, count_rows, decode, rule_violations, sample_rows

PAYLOADS = [
    '{"user_id":"1","gender":"Male","annual_income":20000,"transaction_amount":1.0,"user_rating":5.0,'
    '"session_duration":1800,"date_of_birth":"2006-01-01 00:00:00","payment_method":"PayPal",'
    '"subscription_type":"Basic","customer_status":"Active"}',
    '{"user_id":"2","gender":"male","annual_income":19999,"transaction_amount":10.123,"user_rating":4.55,'
    '"session_duration":0,"date_of_birth":"2006-01-02 00:00:00","payment_method":"Cash",'
    '"subscription_type":"Gold","customer_status":"Gone"}',
    '{"user_id":"3","transaction_amount":1000.5,"user_rating":0.5,"date_of_birth":"1932-12-31 00:00:00"}',
    '{"user_id":"4"}',
]


def test_rules(inbox):
    records = accepted(decode(inbox(PAYLOADS)))
    rules = activity_rules(as_of=F.lit("2024-01-01 00:00:00").cast("timestamp"))
    broken = {r.rule: r.n_broken for r in rule_violations(records, rules).collect()}
    assert broken == {
        "gender": 1,
        "payment_method": 1,
        "subscription_type": 1,
        "customer_status": 1,
        "annual_income": 1,
        "transaction_amount": 1,
        "transaction_amount_scale": 1,
        "session_duration": 1,
        "user_rating": 1,
        "user_rating_scale": 1,
        "age": 2,
    }


def test_rules_take_one_pass(inbox):
    plan = plan_of(rule_violations(accepted(decode(inbox(PAYLOADS))), activity_rules()))
    assert plan.count("from_json(") == 1 and plan.count("Exchange") == 1


def test_sample_and_count(spark):
    df = spark.range(20)
    assert sample_rows(df, 3).count() == 3
    assert [r.id for r in sample_rows(df, 2, "id").collect()] == [0, 1]
    assert tuple(count_rows(df, "ids").first()) == ("ids", 20)
