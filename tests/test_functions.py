from conftest import ev

from clickweave import functions as cf


def _one(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_price_classes(make_events):
    prices = [49.99, 50.0, 99.99, 100.0, 199.99, 200.0, 499.99, 500.0, None]
    df = make_events([ev(price=p, event_id=i) for i, p in enumerate(prices)]).orderBy("event_id")
    assert _one(df, cf.price_range()) == ["low", "medium", "medium", "medium", "medium", "high",
                                          "high", "high", "high"]
    assert _one(df, cf.price_band()) == ["0-50", "50-100", "50-100", "100-200", "100-200",
                                         "200-500", "200-500", "500+", None]


def test_referrer_and_mobile(make_events):
    refs = [None, "https://google.com", "https://facebook.com", "https://instagram.com", "direct",
            "https://GOOGLE.com"]
    df = make_events([ev(referrer=r, event_id=i) for i, r in enumerate(refs)]).orderBy("event_id")
    assert _one(df, cf.referrer_type()) == ["direct", "search", "social", "other", "other", "other"]
    agents = ["Mozilla (iPhone)", "x ANDROID y", "Windows NT", None, "Some Mobile thing"]
    df = make_events([ev(agent=a, event_id=i) for i, a in enumerate(agents)]).orderBy("event_id")
    assert _one(df, cf.is_mobile()) == [True, True, False, None, True]


def test_time_classes(make_events):
    # 2024-01-05 is a Friday
    stamps = ["2024-01-05 05:59:59", "2024-01-05 06:00:00", "2024-01-05 11:59:59", "2024-01-05 12:00:00",
              "2024-01-06 17:00:00", "2024-01-06 18:00:00", "2024-01-07 22:30:00", "2024-01-08 23:00:00"]
    df = make_events([ev(ts=t, event_id=i) for i, t in enumerate(stamps)]).orderBy("event_id")
    assert _one(df, cf.time_segment()) == ["night", "morning", "morning", "afternoon", "afternoon",
                                           "evening", "evening", "night"]
    assert _one(df, cf.day_of_week()) == [6, 6, 6, 6, 7, 7, 1, 2]
    assert _one(df, cf.is_weekend()) == [False, False, False, False, True, True, True, False]
    assert _one(df, cf.hour_of_day()) == [5, 6, 11, 12, 17, 18, 22, 23]


def test_null_time_is_not_weekend(make_events):
    df = make_events([ev(ts=None)])
    assert _one(df, cf.is_weekend()) == [False]
    assert _one(df, cf.time_segment()) == ["night"]


def test_action_weight_and_ratio(make_events):
    acts = ["purchase", "add_to_cart", "click", "view", "error", None]
    df = make_events([ev(action=a, event_id=i) for i, a in enumerate(acts)]).orderBy("event_id")
    assert _one(df, cf.action_weight()) == [4.0, 3.0, 2.0, 1.0, 1.0, 1.0]
    vals = _one(df, cf.safe_ratio("product_price", "event_id"))
    assert vals[0] is None and vals[1] == 10.0


def test_behavior_json_and_key(make_events):
    df = make_events([ev(product="p9", action="click", category="Toys", price=12.5,
                         ts="2024-01-05 10:00:00.123456")])
    js = _one(df, cf.behavior_json())[0]
    assert js == ('{"product_id":"p9","action_type":"click","category":"Toys","price":12.5,'
                  '"timestamp":"2024-01-05 10:00:00"}')
    assert _one(df, cf.serving_key("user", "user_id", "recent_behaviors")) == ["user:u1:recent_behaviors"]
