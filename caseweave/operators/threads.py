"""Reply threads: brand slices, neighbours, ancestor chains and context windows.

Threads stay in long form, one row per (leaf, turn), so that no task has to hold a whole thread. The nested form
of :func:`nest_threads` is for the sinks whose record is one thread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from caseweave.functions import text as tx
from caseweave.operators.sampling import keep_first
from caseweave.session import cut_lineage


def messages_with_ids(messages: DataFrame, ids: DataFrame) -> DataFrame:
    """Messages whose id is in ``ids`` (column ``tweet_id``)."""
    return messages.join(ids.select("tweet_id"), "tweet_id", "left_semi")


def brand_slice(messages: DataFrame, brand: str, include_openers: bool = False) -> DataFrame:
    """Messages by the brand and inbound replies to them; optionally also the messages that the brand answered."""
    written = F.coalesce(F.col("author_id") == brand, F.lit(False))
    own = messages.where(written)
    own_ids = own.select(F.col("tweet_id").alias("in_response_to_tweet_id"))
    others = messages.where(~written & F.col("inbound"))
    replies = others.join(own_ids, "in_response_to_tweet_id", "left_semi").select(*messages.columns)
    result = own.unionByName(replies)
    if include_openers:
        answered = own.where("in_response_to_tweet_id IS NOT NULL").select(
            F.col("in_response_to_tweet_id").alias("tweet_id")
        )
        openers = messages.where(~written).join(answered, "tweet_id", "left_semi")
        openers = openers.join(replies.select("tweet_id"), "tweet_id", "left_anti")
        result = result.unionByName(openers.select(*messages.columns))
    return result


def neighbours(messages: DataFrame, targets: DataFrame) -> DataFrame:
    """The target messages with their parents and listed children: one hop in both directions."""
    chosen = messages_with_ids(messages, targets)
    parents = chosen.select(F.col("in_response_to_tweet_id").alias("tweet_id"))
    children = chosen.select(F.explode(tx.split_ids(F.col("response_tweet_id"))).alias("tweet_id"))
    ids = targets.select("tweet_id").union(parents).union(children).where("tweet_id IS NOT NULL").distinct()
    return messages_with_ids(messages, ids)


def follow(pointers: DataFrame, starts: DataFrame, max_hops: int | None = None) -> DataFrame:
    """All (start, node, hops) that are reached by following one pointer per node.

    ``pointers`` is (node, next), ``starts`` is (start). Each round doubles the reach: ``reach`` covers the hops
    below ``span`` and ``jumps`` leads ``span`` hops ahead, so a chain of depth d takes log2(d) rounds. On a cycle
    a node is met again and again; its smallest hop count is kept, and an unbounded walk ends when a round finds
    nothing new. A bounded walk takes a fixed number of rounds and drops repeats once at the end.
    """
    bounded = max_hops is not None

    def nearest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("start", "node").agg(F.min("hops").alias("hops"))

    jumps = (
        pointers.where("node IS NOT NULL AND next IS NOT NULL")
        .groupBy("node")
        .agg(F.min("next").alias("next"))
    )
    reach = starts.select("start", F.col("start").alias("node"), F.lit(0).cast("bigint").alias("hops")).distinct()
    reach = cut_lineage(reach)
    size, span = (0 if bounded else reach.count()), 1
    while not bounded or span <= max_hops:
        jumps = cut_lineage(jumps)
        ahead = reach.join(jumps, "node").select(
            "start", F.col("next").alias("node"), (F.col("hops") + span).alias("hops")
        )
        if bounded:
            reach = cut_lineage(reach.unionByName(ahead.where(F.col("hops") <= max_hops)))
        else:
            reach = cut_lineage(nearest(reach.unionByName(ahead)))
            grown = reach.count()
            if grown == size:
                break
            size = grown
        span *= 2
        onward = jumps.select(F.col("node").alias("next"), F.col("next").alias("after"))
        jumps = jumps.join(onward, "next").select("node", F.col("after").alias("next"))
    return nearest(reach) if bounded else reach


def parent_pointers(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("tweet_id").alias("node"), F.col("in_response_to_tweet_id").alias("next"))


def first_child_pointers(messages: DataFrame) -> DataFrame:
    first = F.try_element_at(tx.split_ids(F.col("response_tweet_id")), F.lit(1))
    return messages.select(F.col("tweet_id").alias("node"), first.alias("next"))


def ancestor_ids(messages: DataFrame, targets: DataFrame) -> DataFrame:
    """Ids of the targets and all their ancestors, also of ancestors that are not in the table."""
    reach = follow(parent_pointers(messages), targets.select(F.col("tweet_id").alias("start")))
    return reach.select(F.col("node").alias("tweet_id")).distinct()


def reply_chains(messages: DataFrame, leaves: DataFrame, max_hops: int | None = None) -> DataFrame:
    """The chain from the root down to each leaf as one row per turn, oldest first.

    ``leaves`` is (brand, support_tweet_id). The walk ends at a message without a parent, at a parent that is not
    in the table, or where it would visit a message twice.
    """
    starts = leaves.select(F.col("support_tweet_id").alias("start"))
    reach = follow(parent_pointers(messages), starts, max_hops)
    turns = reach.join(messages, F.col("node") == F.col("tweet_id")).select(
        F.col("start").alias("support_tweet_id"),
        "hops",
        "tweet_id",
        tx.speaker_of(F.col("inbound")).alias("speaker"),
        "author_id",
        "created_at",
        "text",
        F.col("in_response_to_tweet_id").alias("parent_id"),
    )
    turns = cut_lineage(keep_first(turns, ["support_tweet_id", "hops"], ["created_at", "author_id", "text"]))
    lengths = turns.groupBy("support_tweet_id").agg(F.count(F.lit(1)).alias("num_messages"))
    heads = leaves.select("brand", "support_tweet_id").distinct().join(lengths, "support_tweet_id")
    return turns.join(heads, "support_tweet_id").select(
        "brand",
        "support_tweet_id",
        "num_messages",
        (F.col("num_messages") - F.col("hops")).alias("position"),
        "tweet_id",
        "speaker",
        "author_id",
        "created_at",
        "text",
        "parent_id",
    )


def nest_threads(turns: DataFrame) -> DataFrame:
    """One THREAD record per leaf. A record holds its whole thread, so a thread must fit in a row."""
    turn = F.struct("position", "tweet_id", "speaker", "author_id", "created_at", "text", "parent_id")
    nested = turns.groupBy("brand", "support_tweet_id", "num_messages").agg(
        F.sort_array(F.collect_list(turn)).alias("_turns")
    )
    conversation = F.transform("_turns", lambda t: t.dropFields("position"))
    return nested.select(
        "brand",
        "support_tweet_id",
        F.col("num_messages").cast("int").alias("num_messages"),
        conversation.alias("conversation"),
    )


def unnest_threads(threads: DataFrame) -> DataFrame:
    """THREAD records back to one row per turn."""
    exploded = threads.select(
        "brand", "support_tweet_id", F.col("num_messages").cast("bigint").alias("num_messages"),
        F.posexplode("conversation").alias("_at", "_turn"),
    )
    return exploded.select(
        "brand", "support_tweet_id", "num_messages", (F.col("_at") + 1).cast("bigint").alias("position"), "_turn.*"
    )


def thread_summary(turns: DataFrame) -> DataFrame:
    """Threads per brand with the mean, median and greatest length."""
    lengths = turns.where("position = num_messages").select("brand", "num_messages")
    return lengths.groupBy("brand").agg(
        F.count(F.lit(1)).alias("conversations"),
        F.avg("num_messages").alias("avg_messages"),
        F.median("num_messages").alias("median_messages"),
        F.max("num_messages").alias("max_messages"),
    )


def context_windows(
    messages: DataFrame,
    targets: DataFrame,
    max_messages: int = 10,
    text: str = "clean_text",
    customer_label: str = "CUSTOMER",
    support_label: str = "SUPPORT",
) -> DataFrame:
    """(tweet_id, conversation_context): the thread around each target, rendered one line per message.

    The walk goes back to the root first and then forward through the first listed children, up to
    ``max_messages`` in all, and never visits a message twice.
    """
    starts = targets.select(F.col("tweet_id").alias("start")).distinct()
    body = messages.select(
        F.col("tweet_id").alias("node"), "inbound", F.coalesce(F.col(text), F.lit("")).alias("_text")
    )
    present = body.select("node")
    hops = max_messages - 1
    back = follow(parent_pointers(messages), starts, hops).join(present, "node", "left_semi")
    ahead = follow(first_child_pointers(messages), starts, hops).join(present, "node", "left_semi").where("hops > 0")
    seen = ahead.join(back.select("start", "node"), ["start", "node"], "left_semi")
    turning = seen.groupBy("start").agg(F.min("hops").alias("_turn"))
    room = back.groupBy("start").agg((F.lit(max_messages) - F.count(F.lit(1))).alias("_room"))
    ahead = (
        ahead.join(room, "start")
        .join(turning, "start", "left")
        .where((F.col("hops") <= F.col("_room")) & (F.col("_turn").isNull() | (F.col("hops") < F.col("_turn"))))
    )
    places = back.select("start", "node", (-F.col("hops")).alias("place")).unionByName(
        ahead.select("start", "node", F.col("hops").alias("place"))
    )
    return _render(starts, places.join(body, "node"), customer_label, support_label)


def _render(starts: DataFrame, lines: DataFrame, customer_label: str, support_label: str) -> DataFrame:
    speaker = F.when(F.col("inbound"), customer_label).otherwise(support_label)
    line = F.concat(speaker, F.lit(": "), F.trim("_text"))
    kept = lines.where(~tx.is_blank(F.col("_text"))).groupBy("start").agg(
        F.sort_array(F.collect_list(F.struct("place", line.alias("line")))).alias("_lines")
    )
    joined = F.array_join(F.transform("_lines", lambda entry: entry["line"]), "\n")
    return starts.join(kept, "start", "left").select(
        F.col("start").alias("tweet_id"), F.coalesce(joined, F.lit("")).alias("conversation_context")
    )


def speech_of(conversation: Column, speaker: str) -> Column:
    """The normalised texts of one speaker in a nested conversation, joined by blanks."""
    spoken = F.filter(conversation, lambda t: F.lower(t["speaker"]) == speaker)
    texts = F.transform(spoken, lambda t: tx.normalize(t["text"]))
    return F.array_join(F.filter(texts, lambda t: t != ""), " ")
