"""Plain-Python statements of the rules, for small fixtures only."""

from difflib import SequenceMatcher


def keys_of(item):
    alt = {k: v for k, v in item["alt_ids"].items() if v}
    names = [k for k in ("barcode",) if k in alt] + sorted(set(alt) - {"barcode"})
    keys = [(k, alt[k]) for k in names]
    if item["external_id"]:
        keys.append(("external_id", item["external_id"]))
    keys.append(("name_price", (" ".join(item["name"].split()).lower(), item["price"])))
    return keys


def serial_match(prev, cur):
    """In list order, each current row takes its best previous row that is still free."""
    free = set(range(len(prev)))
    holders = [keys_of(p) for p in prev]
    pairs = {}
    for c, item in enumerate(cur):
        options = ((k, p) for k in keys_of(item) for p in sorted(free) if k in holders[p])
        key, p = next(options, (None, None))
        if p is not None:
            free.discard(p)
            pairs[c] = (p, key[0])
    return pairs


def serial_review(prev, cur, threshold, limit):
    """{cur: (prev, rounded ratio)} from name lists [(pos, category, name)]."""
    if len(prev) * len(cur) > limit:
        return {}
    found = []
    for c, c_cat, c_name in cur:
        for p, p_cat, p_name in prev:
            if c_cat == p_cat:
                score = SequenceMatcher(None, c_name, p_name).ratio()
                if score >= threshold:
                    found.append((-score, c, p))
    out, used = {}, set()
    for score, c, p in sorted(found):
        if c not in out and p not in used:
            out[c] = (p, round(-score, 4))
            used.add(p)
    return out
