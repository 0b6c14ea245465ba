from tillwise.llm import line_dedup


def cleaned(docs, **options):
    return line_dedup.without_shared_lines(docs, **options)


def brute_force(rows, min_sites=line_dedup.MIN_SITES):
    sites, owner = {}, {}
    for i, text, source in rows:
        for line in {x.strip(" \t\r\x0b\x0c") for x in (text or "").split("\n")} - {""}:
            sites.setdefault(line, set()).update([source] if source is not None else [])
            owner[line] = min(owner.get(line, i), i)
    out = {}
    for i, text, _ in rows:
        gone = lambda x: len(sites.get(x.strip(" \t\r\x0b\x0c"), ())) >= min_sites and owner[x.strip(" \t\r\x0b\x0c")] != i  # noqa: E731,B023
        out[i] = "\n".join(x for x in text.split("\n") if not gone(x))
    return out


def test_shared_lines_stay_in_one_document(documents):
    rows = [(i, f"own line {i}\n  menu home about \n\nsite {i % 2} line\nrare", f"s{i % 5}") for i in range(20)]
    rows += [(50, "menu home about", "s9"), (51, "rare\nrare", "s0")]
    found = {r.doc_id: r.text for r in cleaned(documents(rows)).collect()}
    assert found == brute_force(rows)
    assert found[50] == "" and "menu" in found[0] and "menu" not in found[1]


def test_lines_far_beyond_the_threshold_are_left_to_the_sketch(documents):
    rows = [(i, f"everywhere\nunique {i}", f"site{i}") for i in range(300)]
    rows += [(1000 + i, f"twice\nalone {i}", f"pair{i}") for i in range(2)]
    found = {r.doc_id: r.text for r in cleaned(documents(rows)).collect()}
    assert found == brute_force(rows)


def test_white_space_at_the_ends_does_not_hide_a_line(documents):
    rows = [(i, f"{a}shared words{b}\nown {i}", f"s{i}") for i, (a, b) in enumerate([("", "\r"), ("\t", ""), (" ", " \x0b "), ("\x0c \t", "\r "), ("", "")])]
    rows.append((9, "\tshared\twords\r\n \t\r", "s9"))
    found = {r.doc_id: r.text for r in cleaned(documents(rows)).collect()}
    assert found == brute_force(rows)
    assert [found[i] for i in range(1, 5)] == [f"own {i}" for i in range(1, 5)] and found[9] == rows[-1][1]


def test_counts_and_odd_rows(documents, odd_rows):
    docs = documents(odd_rows, clash=True)
    out = cleaned(docs, counts=True).collect()
    assert len(out) == len(odd_rows)
    by_id = {r.doc_id: r for r in out if r.doc_id is not None}
    assert by_id[1].n_removed == 0 and by_id[2].n_removed == 1 and by_id[3].n_removed == 1
    assert by_id[4].text is None and by_id[4].n_lines == 0
    assert by_id[5].text == "" and by_id[6].text == " \n\t "
    assert cleaned(docs).columns == docs.columns
    assert cleaned(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(documents, capsys):
    cleaned(documents([(1, "a", "s")])).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan
