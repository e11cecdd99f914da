"""Plain versions of the operators, for comparison on small tables."""

import hashlib
import re
from collections import Counter, defaultdict
from html.parser import HTMLParser

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def substring_dedup(docs, window=35):
    own = [(i, words(t)) for i, t in docs]
    count = Counter(tuple(w[k : k + window]) for _, w in own for k in range(len(w) - window + 1))
    out = []
    for i, w in own:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = [True] * window
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest()))
    return sorted(out, key=str)


def suffix_dedup(docs, window=100):
    """docs without rows that share a doc_id."""
    seen, out = set(), []
    for i, t in sorted(docs, key=lambda d: (d[0] is not None, d[0])):
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - window + 1):
            if b[k : k + window] in seen:
                gone[k : k + window] = [True] * window
            seen.add(b[k : k + window])
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def shingles(text, n):
    w = words((text or "").translate(LOWER))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def near_components(docs, n, percent=80):
    """doc_id -> (set size, component); docs without rows that share a doc_id."""
    sets = {i: shingles(t, n) for i, t in docs}
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    where = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    common = Counter()
    for ids in where.values():
        for a in range(len(ids)):
            for b in range(a + 1, len(ids)):
                common[ids[a], ids[b]] += 1
    for (a, b), c in common.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def leaks(docs, items, min_words=13, share=0.8):
    """(doc, item) for which a whole item stands in a document with `share` of its words in place (a lower bound of what must be found)."""
    rx = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    norm = lambda t: rx.findall((t or "").translate(LOWER))
    out = set()
    for i, t in docs:
        w = norm(t)
        for j, u in items:
            v = norm(u)
            if v and any(sum(a == b for a, b in zip(w[k : k + len(v)], v)) >= max(share * len(v), 1) for k in range(len(w) - len(v) + 1)):
                out.add((i, j))
    return out


def license_base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    at = [(k, label) for p, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")) for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    return len(w), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def licences(text, templates, least, base_score):
    """labels and score."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    base = license_base(text)
    labels, score = set(filter(None, base[4].split(","))), 0.0
    for label, notice, key in templates:
        t, k = notice.split(), key.split()
        for start in range(1 - len(t), len(w)):
            lo, hi = max(0, start), min(len(w), start + len(t))
            share = sum(a == b for a, b in zip(w[lo:hi], t[lo - start : hi - start])) / len(t)
            around = w[max(0, lo - len(k)) : hi + len(k)]
            if share >= least and any(around[i : i + len(k)] == k for i in range(len(around) - len(k) + 1)):
                labels.add(label)
                score = max(score, share)
    return ",".join(sorted(labels)), round(score or (base_score if base[1] else 0.0), 9)


NOTICES = "all rights reserved,cookie policy,privacy policy,terms of use,terms of service,enable javascript,javascript is disabled,lorem ipsum,alle rechte vorbehalten,cookie richtlinie,datenschutzerklärung,nutzungsbedingungen,javascript aktivieren,tous droits réservés,politique de confidentialité,conditions d utilisation,mentions légales,todos los derechos reservados,política de privacidad,política de cookies,términos de uso,aviso legal".split(",")
ACTIONS = "click here,sign in,log in,share this,subscribe to our newsletter,hier klicken,jetzt anmelden,newsletter abonnieren,cliquez ici,se connecter,abonnez vous,haga clic aquí,iniciar sesión,suscríbase".split(",")


def quality(text):
    """The cleaned text of a document that is kept, else None."""
    lines = [x for x in (text or "").split("\n") if words(x)]
    good = []
    for i, line in enumerate(lines):
        w = words(line)
        chars = "".join(w)
        said = " " + " ".join(re.findall(r"[^\W_]+", line.lower())) + " "
        nxt = words(lines[i + 1])[0] if i + 1 < len(lines) else ""
        bad = line.count("|") >= 2 or "»" in line or "›" in line or sum(c in "#*$%&|<>" for c in chars) * 100 > len(chars) * 10 or line.count("!!") >= 3
        if len(w) >= 10:
            bad = bad or not (any(c in ".!?:;…。！？؟।" for c in line) or nxt[:1].islower())
        else:
            bad = bad or any(f" {p} " in said for p in NOTICES) or any(said.startswith(f" {p} ") for p in ACTIONS)
        if not bad:
            good.append(line)
    w = words(text)
    at = {}
    for k in range(len(w) - 7):
        at.setdefault(tuple(w[k : k + 8]), []).append(k)
    repeated = len({p + j for places in at.values() if len(places) > 1 for p in places for j in range(8)})
    if len(w) < 20 or 100 * repeated > 30 * len(w):
        return None
    lost = sum(map(len, w)) - sum(len(x) for line in good for x in words(line))
    return "\n".join(good) if lost * 100 <= sum(map(len, w)) * 50 else None


def contaminated(docs, items, min_words=13, share=0.8):
    """The documents in which, on some diagonal, a stretch of min(min_words, the item's words) or more agrees in `share`; it begins and ends on a word that agrees or at an end of the item."""
    rx = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    norm = lambda t: rx.findall((t or "").translate(LOWER))
    sides = [norm(t) for _, t in items]
    out = set()
    for i, t in docs:
        w = norm(t)
        where = defaultdict(list)
        for k, x in enumerate(w):
            where[x].append(k)
        for v in filter(None, sides):
            agree = defaultdict(list)
            for j, x in enumerate(v):
                for k in where.get(x, ()):
                    agree[k - j].append(j)
            least = min(len(v), min_words)
            for start, same in agree.items():
                begins = sorted({*same, *([0] if start >= 0 else [])})
                ends = sorted({*same, *([len(v) - 1] if start + len(v) <= len(w) else [])})
                if len(same) + 1e-9 >= share * least and any(e - b + 1 >= least and sum(b <= j <= e for j in same) + 1e-9 >= share * (e - b + 1) for b in begins for e in ends):
                    out.add(i)
    return out


SECRETS = [
    (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, "assign"),
    (r"(AKIA[A-Z0-9]+)", 1, 20, "access"),
    (r"([0-9a-f]+)", 1, 24, "hex"),
    (r"(gh[pousr]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{20,}|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]{10,})", 1, 10, "vendor"),
]


def redacted(rows, many_owners=3, many_repos=6):
    """doc_id -> text, of rows (doc_id, text, owner, repo)."""
    found = {i: sorted((m.start(), no, m.end(), kind, m[g]) for no, (rx, g, least, kind) in enumerate(SECRETS) for m in re.finditer(rx, t or "") if len(m[g]) >= least) for i, t, _, _ in rows}
    owners, repos = defaultdict(set), defaultdict(set)
    for i, _, owner, repo in rows:
        for s in found[i]:
            owners[s[4]].add(owner or "")
            repos[s[4]].add((owner or "", repo or ""))
    out = {}
    for i, t, _, _ in rows:
        at, text = 0, ""
        for a, _, e, kind, value in found[i]:
            if len(owners[value]) >= many_owners or (len(owners[value]) > 1 and len(repos[value]) >= many_repos):
                continue
            if a >= at:
                text += t[at:a] + f"[{kind}]"
            at = max(at, e)
        out[i] = t if t is None else text + t[at:]
    return out


class Page(HTMLParser):
    """A page as the standard library's parser reads it: text, title, language, references of a elements."""

    HIDDEN = {"script", "style", "noscript", "template", "title", "head"}
    BLOCKS = set("p br div li ul ol tr table h1 h2 h3 h4 h5 h6 article section nav header footer main aside blockquote pre td th dd dt".split())

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.out, self.deep, self.title, self.in_title, self.lang, self.links = [], 0, None, False, None, []
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag in self.HIDDEN:
            self.deep += 1
        if tag in self.BLOCKS and not self.deep:
            self.out.append("\n")
        if tag == "title" and self.title is None:
            self.title, self.in_title = "", True
        if tag == "html" and self.lang is None:
            self.lang = attrs.get("lang")
        if tag == "a" and "href" in attrs:
            self.links.append(attrs["href"] or "")

    def handle_endtag(self, tag):
        if tag in self.HIDDEN and self.deep:
            self.deep -= 1
            self.out.append(" ")
        if tag in self.BLOCKS and not self.deep:
            self.out.append("\n")
        if tag == "title":
            self.in_title = False

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        if not self.deep:
            self.out.append(data)

    @property
    def text(self):
        lines = (" ".join(x.split()) for x in "".join(self.out).split("\n"))
        return "\n".join(x for x in lines if x)
