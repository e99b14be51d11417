import itertools
import random

import pytest
from pyspark.sql import functions as F

from terrace.llm import toxicity
from terrace.llm import toxicity as X
from terrace.llm.common import held_out
from terrace.llm.toxicity import Grammar

G = Grammar()


def weight(text):
    return sum(G.clauses(text))


def test_clauses_match_and_single_words_do_not():
    assert weight("you are an idiot") > weight("this idiot") > weight("this is not an idiot") > 0
    assert weight("he said you are an idiot") < weight("you are an idiot")
    assert weight("I will kill you") > 0 and weight("kill the process") == 0
    assert weight("idiot") == weight("an idiot") == weight("The word idiot is an insult.") == 0
    assert weight("idiot and a moron") > 0
    # a report behind a quotation counts, also behind a mark inside it; one behind plain words does not
    assert weight("'You idiot', he said") == weight('"You idiot!" he said') == weight("You idiot") / 2
    assert weight("you idiot, as he said") == weight("You idiot")
    # negation and report end with the clause; negation also fades within it
    assert weight("is not so. an idiot") == 0
    assert weight("he said no. this idiot") == weight("this idiot")
    assert weight("not the one that came, this idiot") == weight("this idiot")
    assert len(G.clauses("you idiot! and you moron; plain words\nthis scum")) == 3
    # bare insults in several clauses match together
    assert len(G.clauses("idiot! and a moron; plain words\nscum")) == 1 and G.clauses("idiot! plain words") == []


def one_by_one(clause):
    """What the transducers say when each runs over the whole output of the one before."""
    symbols, last = [(k, 0) for k, _ in clause], []
    for t in toxicity.transducers():
        state, symbols = t.run(symbols)
        last.append(state)
    return [m for _, m in symbols], toxicity.accepted(*last[1:])


def by_position(clause):
    """Weight of a clause from the positions of its symbols, without any state."""
    kinds, n = [k for k, _ in clause], len(clause)
    quotes = [i for i in range(n) if kinds[i] == X.QUOTE]
    told = any(kinds[j] == X.REPORT and X.QUOTE not in kinds[c + 1:j] for c in quotes[1::2]
               for j in range(c + 1, min(n, c + 1 + X.QUOTE_REACH)))
    total = {X.INSULT: 0.0, X.THREAT: 0.0}
    for i, (k, w) in enumerate(clause):
        if k in total:
            w *= X.NEG_FACTOR if X.NEGATION in kinds[max(0, i - X.NEG_REACH):i] else 1
            if X.REPORT in kinds[:i]:
                w *= X.REPORT_FACTOR
            elif sum(q < i for q in quotes) % 2 and told:
                w *= X.REPORT_FACTOR
            total[k] += w
    target, n_insults = X.TARGET in kinds, kinds.count(X.INSULT)
    linked = any(k == X.INSULT and X.LINK in kinds[:i] for i, k in enumerate(kinds))
    insults = total[X.INSULT] * (target or linked or n_insults > 1)
    return (insults + total[X.THREAT] * target) * (X.TARGET_FACTOR if target else 1), 0.0 if insults else total[X.INSULT]


def test_composition_equals_the_transducers_one_by_one_on_all_short_clauses():
    m = X.machine()
    for n in range(6):
        for kinds in itertools.product(X.SYMBOLS, repeat=n):
            clause = [(k, {X.INSULT: 3.0, X.THREAT: 4.0}.get(k, 0.0)) for k in kinds]
            state, marks = 0, []
            for k in kinds:
                state, mark = m.step[state + k]
                marks.append(mark)
            assert (marks, m.last[state >> 3]) == one_by_one(clause), kinds
            assert m.weight(clause) == pytest.approx(by_position(clause)), kinds


def test_longer_clauses():
    rng = random.Random(12)
    for _ in range(3000):
        clause = [(k, {X.INSULT: rng.random() + 1, X.THREAT: 4.0}.get(k, 0.0)) for k in rng.choices(X.SYMBOLS, k=rng.randint(6, 25))]
        assert X.machine().weight(clause) == pytest.approx(by_position(clause)), clause


def test_score_bounds_and_order():
    texts = ["", None, "plain text", "an idiot", "this idiot", "you idiot! you moron! you scum!"]
    s = [G.score(t) for t in texts]
    assert all(0 <= x <= 1 for x in s) and s[0] == s[1] == s[2] == s[3] < s[4] < s[5]


@pytest.fixture
def labelled(spark, make_docs):
    rng = random.Random(3)
    base = ["".join(rng.choice("aeiou") + rng.choice("bdklmn") for _ in range(4)) for _ in range(400)]
    rows, labels = [], []
    for i in range(1500):
        toxic = int(i % 4 == 0)
        words = [rng.choice(base) for _ in range(30)]
        if toxic:
            words[5:5] = ["grum" + rng.choice(["", "ak", "eli"]), rng.choice(["zoltar", "pexix"])]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    # many copies of one toxic document must not make insults of its words
    copy = " ".join(f"copied{j}" for j in range(30)) + " you zoltar"
    rows += [(2000 + i, copy) for i in range(100)]
    labels += [(2000 + i, 1, 1) for i in range(100)]
    return make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict(rows)


def test_lexicon_is_learned_and_held_out_rows_are_told_apart(labelled):
    docs, labels, _ = labelled
    g = toxicity.train(docs, labels)
    assert g.insult("zoltar") and g.insult("pexix") and g.insult("grumxyz") and not g.insult("copied3")
    s = toxicity.score(docs, g).join(labels, "doc_id").where(held_out(F.col("doc_id")))
    assert s.where((F.col("toxicity") >= 0.5) != (F.col("toxic") == 1)).count() == 0 and s.count() > 200
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.join(labels.where("toxic = 1"), "doc_id").count() == 0
    assert kept.count() == labels.where("toxic = 0").count()


def test_labels_of_held_out_rows_are_never_used(labelled):
    docs, labels, _ = labelled
    flipped = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, flipped)
    assert (a.words, a.stems, a.curve) == (b.words, b.stems, b.curve)


def test_odd_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    g = toxicity.train(odd_docs, none)
    s = toxicity.score(odd_docs.withColumn("toxicity", F.lit("old")), g)
    assert s.count() == 8 and s.where("toxicity >= 0.5").count() == 0
    assert toxicity.drop_toxic(odd_docs, none).count() == 8
    some = spark.createDataFrame([(1, 1, 1), (None, 1, 1), (4, None, None), (6, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.drop_toxic(odd_docs, some).columns == odd_docs.columns
    assert toxicity.drop_toxic(no_docs, none).count() == 0
