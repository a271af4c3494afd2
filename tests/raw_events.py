"""Hand-made raw rows that the tests share."""

import datetime as dt

UTC = dt.timezone.utc
BASE = dt.datetime(2024, 3, 10, 12, 0, 0, tzinfo=UTC)


def us(t: dt.datetime) -> int:
    return int((t - dt.datetime(1970, 1, 1, tzinfo=UTC)).total_seconds()) * 1_000_000 + t.microsecond


def raw_event(user="u1", at=BASE, name="screen_view", params=None, user_props=None,
              platform="ANDROID", country="Arvenia", offset=0, medium="organic",
              event_date=None):
    """One raw row in RAW_SCHEMA order. params: key -> (slot, value)."""
    slots = ("string_value", "int_value", "float_value", "double_value")

    def kv(items, with_ts):
        out = []
        for key, (slot, value) in (items or {}).items():
            vals = [value if s == slot else None for s in slots]
            if with_ts:
                vals.append(None)
            out.append((key, tuple(vals)))
        return out

    ts = us(at) if at is not None else None
    day = event_date or (at.strftime("%Y%m%d") if at is not None else BASE.strftime("%Y%m%d"))
    device = ("mobile",) + (None,) * 4 + ("Android",) + (None,) * 3 + ("en-us", "No", 0, None,
                                                                      None, None)
    return (day, ts, name, kv(params, False), None, None, 1, offset, None, user,
            kv(user_props, True), ts, None, device,
            ("Imagined", country, None, None, None, None),
            ("app", "1.0", "store", None, None), ("camp", medium, "src"), "100", platform, None)
