"""Small inputs with known answers: fixed values, which must be as they are for the expected results to hold."""


def event(event_id, kind, user, ts, source="web", payload=None, **more):
    body = {"event_id": event_id, "event_type": kind, "user_id": user, "event_ts": ts, "source": source}
    return {**body, "payload": payload if payload is not None else {"page": "/home"}, **more}


T = "2026-06-30T14:0{}:00Z".format

COLLECTED = [
    event("evt_001", "page_view", "user_101", T(0)),
    event("evt_002", "video_play", "user_102", T(1), "mobile"),
    event("evt_003", "purchase", "user_103", T(3)),
    event("evt_004", "page_view", "user_101", T(5)),
    event("evt_005", "add_to_cart", "user_104", T(6), "mobile"),
    event("", "purchase", "user_105", T(7)),
    event("evt_007", "page_view", "", "not-a-timestamp"),
]

BATCH = [
    event("evt_001", "page_view", "user_101", T(0)),
    event("evt_002", "purchase", "user_102", T(1)),
    event("evt_003", "purchase", "user_103", T(2), "mobile"),
    event("evt_004", "video_play", "user_104", T(3), "mobile"),
    event("evt_bad_001", "page_view", "  ", T(4)),
    event("evt_bad_002", "page_view", "user_106", "yesterday"),
]


def flat(number, kind, user, ts, source, amount=None):
    return {
        "event_id": f"evt_{number:03d}", "event_type": kind, "user_id": f"user_{user}", "event_ts": ts, "source": source,
        "session_id": f"sess_{number}", "amount": amount,
    }


FLAT = [
    flat(1, "page_view", 101, "2026-07-06T14:00:00Z", "web"),
    flat(2, "video_play", 102, "2026-07-06T14:03:00Z", "mobile"),
    flat(3, "purchase", 103, "2026-07-06T14:07:00Z", "web", 19.99),
    flat(4, "page_view", 101, "2026-07-06T14:09:00Z", "web"),
    flat(5, "add_to_cart", 104, "2026-07-06T14:12:00Z", "mobile"),
    flat(6, "purchase", 104, "2026-07-06T14:18:00Z", "mobile", 9.99),
    flat(7, "page_view", 105, "2026-07-07T09:01:00Z", "web"),
    flat(8, "purchase", 106, "2026-07-07T09:05:00Z", "web", 29.99),
    flat(9, "video_play", 102, "2026-07-07T09:08:00Z", "mobile"),
    flat(10, "purchase", 999, "2026-07-07T09:15:00Z", "partner", 49.99),
]

USERS = [
    {"user_id": f"user_{n}", "plan": plan, "region": region}
    for n, plan, region in [
        (101, "free", "us-east"), (102, "premium", "us-west"), (103, "premium", "us-east"),
        (104, "free", "us-central"), (105, "free", "us-east"), (106, "premium", "us-west"),
    ]
]

CHECKED = [
    event("evt_1", "page_view", "u1", T(0)),
    event("evt_2", "purchase", "u1", T(1), payload={"amount": "5.00"}),
    event("evt_2", "purchase", "u2", T(2), payload={"amount": "5.00"}),
    event("", "page_view", "u3", T(3)),
    event("evt_4", "page_view", "", T(4)),
    event("evt_5", "page_view", "u5", "soon"),
    event("evt_6", "purchase", "u6", T(6), payload={"amount": "-1"}),
]
