"""Citation structure: citations, coupling, topics, related papers, cheapest paths, maps and paper search.

Cases: a paper neither cites nor couples with itself; null ids are dropped; papers without links have no related papers; ties end
with the id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.text import strip
from graphloom.session import cut

CITED, BOTH, COUPLED, SHARED, MOST_SHARED = 1.0, 0.25, 2.0, 0.25, 4


#: Entries of a reference list that meet in one task; longer lists meet block by block.
LIST_BLOCK = 1000


def coupling(refs: DataFrame) -> DataFrame:
    """(x, y, shared) with x < y: papers that share entries of reference lists. refs: list_id, item. A list of more than LIST_BLOCK
    entries is cut into blocks, and each two blocks of it meet as a key of their own, so that no list is one task."""
    rows = refs.where("item is not null")
    # the number of rows bounds that of entries, and is counted before the shuffle
    size = rows.groupBy("list_id").agg(F.ceil(F.count("*") / LIST_BLOCK).cast("int").alias("k")).where("k > 1")
    r = rows.distinct().join(size, "list_id", "left").withColumn("k", F.coalesce("k", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("item"), F.col("k")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    left = r.select("list_id", F.col("own").alias("i"), every.alias("j"), F.col("item").alias("x"))
    right = r.select("list_id", F.col("own").alias("j"), every.alias("i"), F.col("item").alias("y"))
    return left.join(right, ["list_id", "i", "j"]).where("x < y").groupBy("x", "y").agg(F.count("*").alias("shared"))


def structure(cites: DataFrame, coupled: DataFrame) -> DataFrame:
    """(node, cites, cited, coupled) of every paper with a link."""
    one = lambda c, *flags: F.struct(F.col(c).alias("node"), *(F.lit(v).alias(k) for k, v in zip(("cites", "cited", "coupled"), flags, strict=True)))
    c = cites.select(F.explode(F.array(one("src", 1, 0, 0), one("dst", 0, 1, 0))).alias("e"))
    k = coupled.select(F.explode(F.array(one("x", 0, 0, 1), one("y", 0, 0, 1))).alias("e"))
    return c.unionByName(k).select("e.*").groupBy("node").agg(*(F.sum(x).cast("long").alias(x) for x in ("cites", "cited", "coupled")))


def symmetric(pairs: DataFrame, *carry: str) -> DataFrame:
    return pairs.select(F.col("x").alias("node"), F.col("y").alias("nbr"), *carry).unionByName(pairs.select(F.col("y").alias("node"), F.col("x").alias("nbr"), *carry))


def related(cites: DataFrame, coupled: DataFrame, authors: DataFrame, years: DataFrame, paper: int, n: int) -> DataFrame:
    """(other, score, cited_in, year): 1 for a citation in either direction, a quarter more for both, 2 for each shared reference list,
    a quarter for each shared author (MOST_SHARED at most). Ties go to the more cited, then the newer, then the smaller id.
    authors: paper, author; years: paper, year. Only links at the paper itself are looked at, and citations of its candidates."""
    kinds = ("o", "i", "c", "w")
    row = lambda df, other, **v: df.select(F.col(other).alias("other"), *((F.col(v[k]) if isinstance(v.get(k), str) else F.lit(v.get(k, 0))).cast("long").alias(k) for k in kinds))
    own = authors.where(F.col("paper") == paper).select("author").distinct()
    shared = authors.join(own, "author", "left_semi").distinct().groupBy("paper").agg(F.count("*").alias("shared"))
    s = row(cites.where(F.col("src") == paper), "dst", o=1).unionByName(row(cites.where(F.col("dst") == paper), "src", i=1)).unionByName(row(shared, "paper", w="shared"))
    s = s.unionByName(row(symmetric(coupled, "shared").where(F.col("node") == paper), "nbr", c="shared"))
    s = s.where(F.col("other") != paper).groupBy("other").agg(F.max("o").alias("o"), F.max("i").alias("i"), F.sum("c").alias("c"), F.sum("w").alias("w"))
    score = F.greatest("o", "i") * CITED + F.col("o") * F.col("i") * BOTH + F.col("c") * COUPLED + F.least("w", F.lit(MOST_SHARED)) * SHARED
    s = s.select("other", score.alias("score"))
    cited = cites.join(s.select(F.col("other").alias("dst")), "dst", "left_semi").groupBy(F.col("dst").alias("other")).agg(F.count("*").alias("cited_in"))
    s = s.join(cited, "other", "left").na.fill(0, ["cited_in"]).join(years.select(F.col("paper").alias("other"), "year"), "other", "left")
    return s.orderBy(F.desc("score"), F.desc("cited_in"), F.desc_nulls_last("year"), "other").limit(n)


def link_weights(cites: DataFrame, coupled: DataFrame) -> DataFrame:
    """(x, y, weight), x < y: 1 if cited either way, and 2 for each shared list."""
    c = cites.select(F.least("src", "dst").alias("x"), F.greatest("src", "dst").alias("y")).where("x < y").distinct().withColumn("w", F.lit(CITED))
    k = coupled.select("x", "y", (F.col("shared") * COUPLED).alias("w"))
    return c.unionByName(k).groupBy("x", "y").agg(F.sum("w").alias("weight"))


def ancestors(topics: DataFrame, depth: int = 8) -> DataFrame:
    """(topic, ancestor) with each topic among its own, by doubling steps of a bounded depth. topics: topic, parent."""
    up = topics.select("topic", F.col("parent").alias("ancestor")).where("ancestor is not null")
    known = topics.select("topic", F.col("topic").alias("ancestor")).unionByName(up).distinct()
    steps = 1
    while steps < depth:
        further = known.select("topic", F.col("ancestor").alias("via")).join(known.select(F.col("topic").alias("via"), "ancestor"), "via").select("topic", "ancestor")
        known = cut(known.unionByName(further).distinct())
        steps *= 2
    return known


def under_topic(papers: DataFrame, tree: DataFrame, topic: str) -> DataFrame:
    """(paper, primary) of papers (paper, topic) in a topic or below it, those of the topic itself, which are primary, first."""
    below = tree.where(F.col("ancestor") == topic).select("topic")
    return papers.join(below, "topic").groupBy("paper").agg(F.max(F.col("topic") == topic).alias("primary")).orderBy(F.desc("primary"), "paper")


def _begins(word: str):
    return lambda x: x.startswith(word)


def topic_search(topics: DataFrame, query: str, least: int = 4) -> DataFrame:
    """Topics of which every word of the query is a word, or the beginning of one from ``least`` letters on."""
    words = F.split(F.lower("topic"), r"[\s/]+")
    every = F.lit(True)
    for w in sorted(set(query.lower().split())):
        hit = F.array_contains(words, w)
        every = every & (hit | F.exists(words, _begins(w)) if len(w) >= least else hit)
    return topics.where(every)


def cheapest(links: DataFrame, start: int, hops: int) -> DataFrame:
    """(node, cost, hops): the cheapest way to each node within the hops; passing a node costs 1 + log2(1 + degree) / 2. Each hop is
    one join of the frontier's best costs with the links, kept as a table in the shared folder. links: x, y."""
    adj = cut(symmetric(links.select("x", "y")))
    toll = adj.groupBy("node").agg((1 + 0.5 * F.log2(1 + F.count("*"))).alias("toll"))
    best = links.sparkSession.createDataFrame([(start, 0.0, 0)], "node long, cost double, hops int")
    for h in range(1, hops + 1):
        # the toll is that of the node entered, so the cheapest way to it is found before it is added
        step = best.where(F.col("hops") == h - 1).join(adj, "node").groupBy(F.col("nbr").alias("node")).agg(F.min("cost").alias("cost"))
        step = step.join(toll, "node").select("node", (F.col("cost") + F.col("toll")).alias("cost"), F.lit(h).alias("hops"))
        whole = best.unionByName(step).groupBy("node").agg(F.min(F.struct("cost", "hops")).alias("b"))
        best = cut(whole.select("node", "b.cost", "b.hops"))
    return best


def cheapest_paths(links: DataFrame, start: int, target: int, k: int, hops: int) -> DataFrame:
    """(pos, cost, hops, path): up to k cheapest paths of at most so many hops between two papers, each without the inner papers of
    those before. Entering a paper costs 1 + log2(1 + degree) / 2, entering the target 1. Each hop is one join of the frontier with
    the links; its rows carry their paths. A paper's dearer state stays if it has fewer hops, and states that can no longer
    undercut the target's cost end. Of equal costs the path with the smaller ids is taken. links: x, y."""
    spark = links.sparkSession
    adj = symmetric(links.select("x", "y")).where("node <> nbr").distinct()
    toll = adj.groupBy("node").agg((1 + 0.5 * F.log2(1 + F.count("*"))).alias("toll"))
    priced = cut(adj.join(toll.withColumnRenamed("node", "nbr"), "nbr").select("node", "nbr", F.when(F.col("nbr") == target, 1.0).otherwise(F.col("toll")).alias("toll")))
    found: list[tuple[int, float, int, list[int]]] = []
    banned: set[int] = set()
    direct = False
    while start != target and len(found) < k:
        use = priced.where(~F.col("nbr").isin([start, *sorted(banned)]))
        if direct:
            use = use.where((F.col("node") != start) | (F.col("nbr") != target))
        front = spark.createDataFrame([(start, 0.0, [start])], "node long, cost double, path array<long>")
        settled, best = front.select("node", "cost"), None
        for _ in range(hops):
            step = front.join(use, "node").select(F.col("nbr").alias("node"), (F.col("cost") + F.col("toll")).alias("cost"), F.concat("path", F.array("nbr")).alias("path"))
            step = step.groupBy("node").agg(F.min(F.struct("cost", "path")).alias("b")).select("node", "b.cost", "b.path")
            # a state with as little cost and fewer hops is better
            step = cut(step.join(settled.withColumnRenamed("cost", "before"), "node", "left").where("before is null or cost < before").drop("before"))
            end = step.where(F.col("node") == target).first()
            if end is not None and (best is None or end["cost"] < best["cost"]):
                best = end
            front = step.where(F.col("node") != target)
            if best is not None:
                front = front.where(F.col("cost") + 1 < best["cost"])
            if front.isEmpty():
                break
            settled = cut(settled.unionByName(step.select("node", "cost")).groupBy("node").agg(F.min("cost").alias("cost")))
        if best is None:
            break
        inner = best["path"][1:-1]
        direct = direct or not inner
        banned.update(inner)
        found.append((len(found) + 1, best["cost"], len(best["path"]) - 1, list(best["path"])))
    return spark.createDataFrame(found, "pos int, cost double, hops int, path array<long>")


def paper_map(links: DataFrame, seed: int, n: int) -> DataFrame:
    """(node, hop, strength) around a seed: first neighbours by weight, second ones by strength * weight / log2(2 + degree)."""
    adj = symmetric(links, "weight").where(F.col("node") != F.col("nbr"))
    deg = adj.groupBy("node").agg(F.count("*").alias("deg"))
    one = adj.where(F.col("node") == seed).groupBy("nbr").agg(F.sum("weight").alias("s")).orderBy(F.desc("s"), "nbr").limit(n)
    first = one.select(F.col("nbr").alias("node"), F.lit(1).alias("hop"), F.col("s").alias("strength"))
    second = F.broadcast(first).join(adj, "node").join(deg, "node").where(F.col("nbr") != seed).join(F.broadcast(first.select(F.col("node").alias("nbr"))), "nbr", "left_anti")
    two = second.groupBy("nbr").agg(F.sum(F.col("strength") * F.col("weight") / F.log2(2 + F.col("deg"))).alias("s")).orderBy(F.desc("s"), "nbr").limit(n)
    return first.unionByName(two.select(F.col("nbr").alias("node"), F.lit(2).alias("hop"), F.col("s").alias("strength")))


def thinned(links: DataFrame, seeds: DataFrame, most: int, per_node: int = 6) -> DataFrame:
    """Links of seeds, the strongest of every other node, and no more than ``most`` besides each node's best. seeds: node. A hub's links
    are cut to ``per_node`` before the shuffle."""
    both = symmetric(links, "weight")
    w = Window.partitionBy("node").orderBy(F.desc("weight"), "nbr")
    pair = [F.least("node", "nbr").alias("x"), F.greatest("node", "nbr").alias("y"), "weight"]
    strongest = both.withColumn("r", F.row_number().over(w)).where(F.col("r") <= per_node).select(*pair, (F.col("r") == 1).alias("best"), F.lit(False).alias("seed"))
    of_seeds = both.join(seeds.select("node"), "node", "left_semi").select(*pair, F.lit(False).alias("best"), F.lit(True).alias("seed"))
    one = strongest.unionByName(of_seeds).groupBy("x", "y").agg(F.max("weight").alias("weight"), F.max("best").alias("best"), F.max("seed").alias("seed"))
    first = one.orderBy(F.desc("seed"), F.desc("weight"), "x", "y").limit(most)
    return one.where("best").select("x", "y", "weight").unionByName(first.select("x", "y", "weight")).distinct()


def doi(c: Column) -> Column:
    """A DOI without resolver, prefix, case and closing signs; null if it is none."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"^(?:https?://)?(?:dx\.)?doi\.org/|^doi:\s*", ""), r"[\s.,;)]+$", "")
    return F.when(plain.rlike(r"^10\.[0-9]{4,9}/\S+$"), plain)


def fold(c: Column) -> Column:
    """Small letters without common accents."""
    return F.translate(F.lower(c), "áàâäãåéèêëíìîïóòôöõøúùûüñçýšžč", "aaaaaaeeeeiiiioooooouuuuncyszc")


def resolve(papers: DataFrame, asked: DataFrame) -> DataFrame:
    """(asked, paper_id, rule) of names of papers (asked): by id, else by DOI in any form, else by folded title; of several papers the
    smallest id. Names that no paper bears have no row."""
    title = lambda c: F.regexp_replace(fold(c), "[^a-z0-9]+", " ")
    keys = papers.select("paper_id", F.explode(F.array(*(F.struct(F.lit(k).alias("rule"), v.alias("key")) for k, v in (("1 id", F.col("paper_id")), ("2 doi", doi(F.col("doi"))), ("3 title", title(F.col("title"))))))).alias("k")).select("paper_id", "k.rule", "k.key")
    keys = keys.where("key is not null and key <> ''").groupBy("rule", "key").agg(F.min("paper_id").alias("paper_id"))
    a = asked.where("asked is not null").select("asked").distinct()
    a = a.select("asked", F.explode(F.array(*(F.struct(F.lit(k).alias("rule"), v.alias("key")) for k, v in (("1 id", F.col("asked")), ("2 doi", doi(F.col("asked"))), ("3 title", title(F.col("asked"))))))).alias("k")).select("asked", "k.rule", "k.key")
    return a.join(keys, ["rule", "key"]).groupBy("asked").agg(F.min(F.struct("rule", "paper_id")).alias("x")).select("asked", "x.paper_id", F.substring("x.rule", 3, 9).alias("rule"))


def paper_search(papers: DataFrame, query: str, n: int = 1000) -> DataFrame:
    """(paper_id, named, whole, title_hits, year, pos): the first ``n`` papers of whose title, venue or authors every word of the query is
    a part (folded): those named by it (the title itself) first, then those with most whole words, most words in the title, newest."""
    words = sorted(set(query.lower().split()))
    plain = lambda c: F.concat(F.lit(" "), F.regexp_replace(fold(c), "[^a-z0-9]+", " "), F.lit(" "))
    text = F.concat_ws(" ", fold(F.col("title")), fold(F.col("venue")), fold(F.array_join("authors.display_name", " ")))
    every = F.lit(True)
    for w in words:
        every = every & text.contains(w)
    count = lambda c, whole: sum((F.when(c.contains(f" {w} " if whole else w), 1).otherwise(0) for w in words), F.lit(0))
    named = F.coalesce(F.trim(plain(F.col("title"))) == " ".join(query.lower().split()), F.lit(False))
    found = papers.where(every).select("paper_id", named.alias("named"), count(plain(text), True).alias("whole"), count(F.coalesce(fold(F.col("title")), F.lit("")), False).alias("title_hits"), F.col("pub_year").alias("year"))
    order = [F.desc("named"), F.desc("whole"), F.desc("title_hits"), F.desc_nulls_last("year"), F.asc("paper_id")]
    best = found.groupBy("paper_id").agg(F.max(F.struct("named", "whole", "title_hits", "year")).alias("x")).select("paper_id", "x.*").orderBy(*order).limit(n)
    return best.withColumn("pos", F.row_number().over(Window.orderBy(*order)) - 1)


#: More works than this with the best score are no answer.
MOST_TIES = 9


def find_works(papers: DataFrame, surnames: list[str], year: int | None) -> DataFrame:
    """(paper_id, score): works of authors of the family names: 1 for each name, 1 if one of them leads, 1 for the exact year. With a
    year, works of other years drop out, but those of a year beside it stay if they score above every work of the year itself. More
    than MOST_TIES works with the best score give nothing."""
    names_ = sorted({fold_text(x) for x in surnames})
    words = F.split(fold(F.col("a.display_name")), "[^a-z]+")
    a = papers.select("paper_id", "pub_year", F.posexplode("authors").alias("i", "a")).select("paper_id", "pub_year", "i", F.explode(F.array_intersect(words, F.array(*map(F.lit, names_)))).alias("s"))
    hit = a.groupBy("paper_id", "pub_year").agg(F.min("i").alias("i"), F.count_distinct("s").alias("names"))
    exact = F.coalesce(F.col("pub_year") == year, F.lit(False)) if year is not None else F.lit(False)
    scored = hit.select("paper_id", "pub_year", exact.alias("exact"), (F.col("names") + (F.col("i") == 0).cast("int") + exact.cast("int")).alias("score"))
    if year is not None:
        floor = scored.where("exact").agg(F.coalesce(F.max("score"), F.lit(0)).alias("floor"))
        scored = scored.join(F.broadcast(floor)).where(F.col("exact") | (F.abs(F.col("pub_year") - year) == 1) & (F.col("score") > F.col("floor")))
    best = scored.agg(F.max("score").alias("top")).join(F.broadcast(scored.groupBy("score").agg(F.count("*").alias("ties"))), F.col("score") == F.col("top")).where(F.col("ties") <= MOST_TIES).select("ties")
    return scored.join(F.broadcast(best)).select("paper_id", F.col("score").cast("long").alias("score"))


def fold_text(x: str) -> str:
    """``fold`` of one word."""
    import unicodedata

    return "".join(c for c in unicodedata.normalize("NFKD", x.lower()) if not unicodedata.combining(c))


MENTION_PARTS = r"([A-Z][a-z]{2,})(?:,? (?:and|&) ([A-Z][a-z]{2,})| et al\.?)?,? \(?((?:19|20)[0-9]{2})"


def cited_works(candidates: DataFrame, works: DataFrame, n: int, most: int = 3) -> DataFrame:
    """(work, mentions, pos): the works that bounded candidates (content) mention most by author and year. works: work, surnames (array,
    in order), year. A mention means the works of its first name and year, narrowed by its second name where that leaves any; none,
    or more than ``most``, mean nothing."""
    m = candidates.select(F.explode(F.regexp_extract_all("content", F.lit(MENTION_PARTS), 0)).alias("m"))
    m = m.groupBy("m").agg(F.count("*").alias("n")).select("m", "n", *(F.lower(F.regexp_extract("m", MENTION_PARTS, i)).alias(k) for i, k in ((1, "first"), (2, "second"))), F.regexp_extract("m", MENTION_PARTS, 3).cast("int").alias("year"))
    w = works.select("work", "year", F.transform("surnames", lambda x: fold(x)).alias("s")).withColumn("first", F.col("s")[0])
    hit = m.join(w, ["first", "year"]).withColumn("both", (F.col("second") != "") & F.array_contains("s", F.col("second")))
    of = hit.groupBy("m").agg(F.max("both").alias("any"))
    hit = hit.join(of, "m").where(~F.col("any") | F.col("both"))
    clear = hit.groupBy("m").agg(F.count_distinct("work").alias("k")).where(F.col("k") <= most)
    ranked = hit.join(clear, "m", "left_semi").groupBy("work").agg(F.sum("n").alias("mentions")).orderBy(F.desc("mentions"), "work").limit(n)
    return ranked.withColumn("pos", F.row_number().over(Window.orderBy(F.desc("mentions"), "work")) - 1)


def passages(chunks: DataFrame, vectors: DataFrame, query: list[float], words: list[str], all_up_to: int = 60, best: int = 40, n: int = 10) -> DataFrame:
    """(work, id, chars, pos): passages of each work for a question. A work of up to ``all_up_to`` distinct texts gives them all, a larger
    one the ``best`` by vector and the ``best`` by text; equal texts are one, with the length of the longest copy and the smallest
    id; they are ranked by the vector, then by the question's words. chunks: work, id, content; vectors: id, vector. Rankings are cut to
    their length before the shuffle."""
    from graphloom.operators.retrieval import cosine, question_terms, terms_of

    c = chunks.where("work is not null and content is not null").withColumn("text", strip(F.col("content"))).where("text <> ''")
    terms = F.array(*map(F.lit, question_terms(words))).cast("array<string>")
    c = c.select("work", "id", F.length("content").alias("chars"), F.md5("text").alias("digest"), F.size(F.array_intersect(terms_of(F.col("content")), terms)).alias("hits"))
    c = c.join(vectors.select("id", cosine(F.col("vector"), query).alias("cosine")), "id", "left")
    one = c.groupBy("work", "digest").agg(F.min("id").alias("id"), F.max("chars").alias("chars"), F.max("hits").alias("hits"), F.max("cosine").alias("cosine"))
    one = cut(one)
    size = one.groupBy("work").agg((F.count("*") <= all_up_to).alias("small"))
    one = one.join(size, "work")
    by_vector = Window.partitionBy("work").orderBy(F.desc_nulls_last("cosine"), "id")
    by_text = Window.partitionBy("work").orderBy(F.desc("hits"), "id")
    near = one.where("not small and cosine is not null").withColumn("_r", F.row_number().over(by_vector)).where(F.col("_r") <= best).drop("_r")
    told = one.where("not small and hits > 0").withColumn("_r", F.row_number().over(by_text)).where(F.col("_r") <= best).drop("_r")
    every = one.where("small").unionByName(near).unionByName(told).distinct()
    rank = Window.partitionBy("work").orderBy(F.desc_nulls_last(F.round("cosine", 9)), F.desc("hits"), "id")
    return every.withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= n).select("work", "id", "chars", (F.col("_r") - 1).alias("pos"))


MENTION = r"([A-Z][a-z]{2,}(?:,? (?:and|&) [A-Z][a-z]{2,}| et al\.?)?,? \(?(?:19|20)[0-9]{2})"


def mentions(df: DataFrame, key: str, text: str) -> DataFrame:
    """(mention, n): author-year mentions of texts."""
    return df.select(F.explode(F.regexp_extract_all(text, F.lit(MENTION), 1)).alias("mention")).groupBy("mention").agg(F.count("*").alias("n"))


def citation_line(author: Column, year: Column, title: Column, most: int = 80) -> Column:
    return F.substring(F.concat_ws(" ", author, F.concat(F.lit("("), year.cast("string"), F.lit(")")), title), 1, most)
