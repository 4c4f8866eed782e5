"""The small labelled table the personal-data model is trained on.

Hand-written lines; a span is marked as [kind:text]. They hold what the base
patterns find and what they miss (numbers without a plus sign, spelled-out
addresses, other separators), and numbers that are not personal data.
"""

ROWS = (
    "please call [phone:+1 (212) 555-0142] before noon",
    "please call [phone:(212) 555-0142] before noon",
    "tel: [phone:212-555-0187] or fax: [phone:212-555-0188]",
    "phone [phone:0044 20 7946 0958] for orders",
    "my number is [phone:415.555.0133] thanks",
    "ring [phone:+44 20 7946 0018] today",
    "call us on [phone:(030) 901820] in berlin",
    "tel. [phone:01 70 18 99 00] paris",
    "mobile: [phone:617 555 0119]",
    "contact ([phone:303-555-0144]) at any time",
    "fax [phone:+49 30 901820-12] office",
    "Call [phone:(617) 555-0190]. Ask for the desk",
    "phone: [phone:(415) 555-0101], or write",
    "whatsapp [phone:+34 612 345 678]",
    "write to [email:jane.doe@example.com] soon",
    "mail [email:info@mail.example.org], or call",
    "mail me: [email:jane at example dot com] please",
    "address is [email:j.smith at mail dot example dot org] ok",
    "email [email:team(at)example.com] now",
    "email [email:press [at] example [dot] net] now",
    "contact [email:bob (at) example (dot) com] for details",
    "send it to [email:12@mail3.example.com] and wait",
    "[email:hans.meier@example.de] ist da",
    "the host [ip:192.0.2.17] is down",
    "ping [ip:10.0.0.1] from home",
    "connect to [ip:203.0.113.9]:8080 first",
    "server at [ip:198.51.100.23], port 22",
    "from [ip:172.16.4.200] to [ip:172.16.4.201]",
    "card [card:4111 1111 1111 1111] was used",
    "card number [card:4111-1111-1111-1111] expired",
    "pay with [card:5500000000000004] today",
    "visa: [card:4012888888881881] exp 12/27",
    "charged to [card:4222.2222.2222.2220] twice",
    "card [card:3782 822463 10005] on file",
    "the and [card:4465758382889437] of then",
    "in 2019 there were 1200 cases and 35 deaths",
    "version 3.2.1 was released on 2021-05-14",
    "chapter 12 pages 340-355 and table 7",
    "a price of 1,299.00 or 15 % less",
    "at 10:30 on 12.05.2020 in room 204",
    "order 20394857 was shipped on 3 may 2021",
    "licensed under cc by-nc 4.0 in 2018",
    "apache license version 2.0 january 2004",
    "isbn 978-3-16-148410-0 second edition",
    "token = \"1eb9c654e721b4f812088970e66a6345cee33dd6\" end",
    "password=a9ce335683f9772ddc and more",
    "sha 9233a8ecf7c5b09fe5949719b6b82bc439e9329b ok",
    "score was 21-14 after 60 minutes",
    "see section 4.2.1.3 of the manual",
    "lat 48.8566 and lon 2.3522 near",
    "we met at 5 or 6 places at the dot",
    "the year 1984 and 1 of 2 or 3",
    "call 2 of 3 was at noon",
    "size 10 x 20 x 30 cm and 4.5 kg",
    "id 100200300400 in table 5",
    "follow @someone on the site at 9",
    "he paid 100 @ 20 each",
    "1990-2000 1,000,000 people at 3 dot 5",
    "public license, version 3. in 2007",
    "a1 b2 c3 d4 e5 f6",
)


def labelled_rows() -> list[tuple[str, list[tuple[str, int, int]]]]:
    """(text, [(kind, start, end)]) of each row."""
    import re
    out = []
    for row in ROWS:
        text, spans, at = "", [], 0
        for m in re.finditer(r"\[(email|ip|card|phone):((?:[^\[\]]|\[(?:at|dot)\])+)\]", row):
            text += row[at:m.start()]
            spans.append((m[1], len(text), len(text) + len(m[2])))
            text += m[2]
            at = m.end()
        out.append((text + row[at:], spans))
    return out
