"""DuckDB SQL with the same result as each query of the catalogue."""

# Shared tables in dependency order. Each may use those before it.
_CTES = {
    "ratings": """
        select cast(o_custkey as int) as userId, cast(l_partkey as int) as movieId,
               cast(l_quantity / 10 as float) as rating,
               cast(epoch(o_orderdate) as bigint) + l_orderkey * 7 + l_linenumber as timestamp
        from lineitem join orders on l_orderkey = o_orderkey""",
    "dirty": """
        select case when timestamp % 97 <> 0 then userId end as userId,
               case when timestamp % 89 <> 0 then movieId end as movieId,
               case when timestamp % 83 = 0 then null when timestamp % 79 = 0 then cast('nan' as float)
                    else rating end as rating,
               timestamp
        from ratings""",
    "movies": """
        select cast(p_partkey as int) as movieId, p_name as title,
               case when p_size < 5 then '(no genres listed)' when p_size < 10 then null else p_type end as genres
        from part""",
    "titled": "select * from movies where movieId in (select p_partkey from part where p_size < 50)",
    "factors": "select cast(vec_id as int) as id, embedding as features from embeddings",
    "clean": "select * from ratings where rating >= 0.5 and rating <= 5.0",
    "clean_dirty": """
        select * from dirty
        where userId is not null and movieId is not null and rating is not null and timestamp is not null
          and not isnan(rating) and rating >= 0.5 and rating <= 5.0""",
    "scores": """
        select u.id as user_idx, i.id as item_idx,
               list_dot_product(cast(u.features as double[]), cast(i.features as double[])) as score
        from factors u cross join factors i""",
    "ranked": """
        select *, cast(row_number() over (partition by user_idx order by score desc, item_idx) as int) as rank
        from scores""",
    "recs": "select * from ranked where rank <= 20",
}


def _pipeline(source: str) -> dict[str, str]:
    """Activity filter, dense ids and split over a table of clean ratings."""
    return {
        "processed": f"""
            select c.* from {source} c
            where userId in (select userId from {source} group by userId having count(*) >= 30)
              and movieId in (select movieId from {source} group by movieId having count(*) >= 25)""",
        "users": """
            select userId, cast(row_number() over (order by count(*) desc, cast(userId as varchar)) - 1 as int) as user_idx,
                   count(*) as n
            from processed group by userId""",
        "items": """
            select movieId, cast(row_number() over (order by count(*) desc, cast(movieId as varchar)) - 1 as int) as item_idx,
                   count(*) as n
            from processed group by movieId""",
        "indexed": """
            select p.userId, p.movieId, rating, timestamp, user_idx, item_idx,
                   case when timestamp % 100 < 80 then 'train' when timestamp % 100 < 90 then 'validation' else 'test' end as split
            from processed p join users u on p.userId = u.userId join items i on p.movieId = i.movieId""",
        "train": "select * from indexed where split = 'train'",
        "test": "select * from indexed where split = 'test'",
    }


_SUITE_CTES = {
    "predictions": """
        select t.*, p.prediction from indexed t
        join (select item_idx, avg(cast(rating as double)) as prediction from train group by item_idx) p
          on t.item_idx = p.item_idx
        where t.split <> 'train'""",
    "relevant": "select user_idx, item_idx, count(*) as copies from test where rating >= 4.0 group by user_idx, item_idx",
    "n_relevant": "select user_idx, sum(copies) as n_relevant from relevant group by user_idx",
    "ks": "select unnest([5, 10, 20]) as k",
    "hits": """
        select ks.k, r.user_idx, count(*) as n_predicted, count(v.item_idx) as hits
        from ks join ranked r on r.rank <= ks.k
        left join relevant v on v.user_idx = r.user_idx and v.item_idx = r.item_idx
        group by ks.k, r.user_idx""",
    "user_metrics": """
        select k, h.user_idx, hits / n_predicted as p, hits / n_relevant as r
        from hits h join n_relevant a on h.user_idx = a.user_idx""",
    "popularity": "select item_idx, count(*) as popularity from train group by item_idx",
}

_UNFILTERED_CTES = {
    "clean_split": """
        select *, case when timestamp % 100 < 80 then 'train' when timestamp % 100 < 90 then 'validation' else 'test' end as split
        from clean""",
    "clean_predictions": """
        select t.*, p.prediction from clean_split t
        join (select movieId, avg(cast(rating as double)) as prediction from clean_split where split = 'train' group by movieId) p
          on t.movieId = p.movieId
        where t.split = 'test'""",
    "segments": """
        select userId, count(*) as n_train,
               case when count(*) < 10 then 'cold' when count(*) >= 50 then 'warm' end as segment
        from clean_split where split = 'train' group by userId""",
    "segment_rmse": """
        select segment, sqrt(avg((prediction - rating) * (prediction - rating))) as rmse, count(*) as num_predictions
        from clean_predictions p join segments s on p.userId = s.userId where segment is not null group by segment""",
}

_ALL = {**_CTES, **_pipeline("clean"), **_SUITE_CTES, **_UNFILTERED_CTES}


def _sampled(column: str, limit: int) -> str:
    """Hash sample with seed 42; ``limit`` is fraction * 2^32."""
    return f"cast('0x' || substr(md5('42:' || cast({column} as varchar)), 1, 8) as bigint) < {limit}"


_TENTH, _QUARTER, _HALF = 429496729, 1073741824, 2147483648

def _suite(ranking: str | None = None, catalog: str | None = None) -> str:
    """The suite over all users, or over those of the given conditions."""
    ranked = f" where {ranking}" if ranking else ""
    chosen = f" and {catalog}" if catalog else ""
    return f"""
    select 'rmse' as metric, split as segment, cast(null as int) as k,
           round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) as value
    from predictions group by split
    union all
    select 'mae', split, null, round(avg(abs(prediction - rating)), 6) from predictions group by split
    union all
    select 'precision', 'test', k, round(avg(p), 6) from user_metrics{ranked} group by k
    union all
    select 'recall', 'test', k, round(avg(r), 6) from user_metrics{ranked} group by k
    union all
    select 'coverage', 'train', 100,
           round((select count(distinct item_idx) from ranked
                  where rank <= 100 and user_idx in (select user_idx from train){chosen})
                 / (select count(*) from popularity), 6)
    union all
    select 'popularity_bias', 'test', 20,
           round((select avg(popularity) from ranked r join popularity p on r.item_idx = p.item_idx
                  where rank <= 20 and user_idx in (select user_idx from test){chosen})
                 / (select avg(popularity) from popularity), 6)
    union all
    select 'rmse', segment, null, round(sqrt(avg((prediction - rating) * (prediction - rating))), 6)
    from predictions p
    join (select user_idx, case when count(*) < 10 then 'cold' when count(*) >= 50 then 'warm' end as segment
          from train group by user_idx) s on p.user_idx = s.user_idx
    where p.split = 'test' and s.segment is not null group by s.segment"""


_SUITE, _SUITE_SAMPLED = _suite(), _suite(_sampled("user_idx", _HALF), _sampled("user_idx", _QUARTER))

_COUNTS_PER_USER = "select userId, count(rating) as n, avg(cast(rating as double)) as a from {0} group by userId"
_COUNTS_PER_ITEM = "select movieId, count(rating) as n, avg(cast(rating as double)) as a from {0} group by movieId"

_STATISTICS = f"""
    select total_ratings, num_users, num_items, round(1 - total_ratings / (num_users * num_items), 6) as sparsity,
           round(avg_rating, 6) as avg_rating, round(std_rating, 6) as std_rating,
           round(avg_ratings_per_user, 6) as avg_ratings_per_user, median_ratings_per_user,
           round(avg_ratings_per_item, 6) as avg_ratings_per_item, median_ratings_per_item
    from (select count(*) as total_ratings, avg(cast(rating as double)) as avg_rating,
                 stddev_samp(cast(rating as double)) as std_rating from processed)
    cross join (select count(*) as num_users, avg(n) as avg_ratings_per_user,
                       cast(quantile_disc(n, 0.5) as double) as median_ratings_per_user
                from ({_COUNTS_PER_USER.format('processed')}))
    cross join (select count(*) as num_items, avg(n) as avg_ratings_per_item,
                       cast(quantile_disc(n, 0.5) as double) as median_ratings_per_item
                from ({_COUNTS_PER_ITEM.format('processed')}))"""


def _activity_stats(per_key: str) -> str:
    return f"""
        select round(avg(n), 6) as avg_ratings, round(stddev_samp(n), 6) as std_ratings,
               min(n) as min_ratings, max(n) as max_ratings from ({per_key})"""


def _median(per_key: str) -> str:
    return f"""
        select round(avg(n), 6) as avg_ratings, cast(quantile_disc(n, 0.5) as double) as median_ratings
        from ({per_key})"""


def _long(report: str, source: str, **values: str) -> str:
    return " union all ".join(
        f"select '{report}' as report, '{name}' as name, round(cast({value} as double), 6) as value from ({source}) t"
        for name, value in values.items()
    )


def _explore(ratings: str) -> str:
    users, items = _COUNTS_PER_USER.format(ratings), _COUNTS_PER_ITEM.format(ratings)
    spread = {
        "avg_ratings": "avg(n)",
        "std_ratings": "stddev_samp(n)",
        "min_ratings": "min(n)",
        "max_ratings": "max(n)",
    }
    cold = {"cold": "count(*) filter (n < 5)", "total": "count(*)", "share": "count(*) filter (n < 5) / count(*)"}
    n_users, n_items = f"(select count(*) from ({users}))", f"(select count(*) from ({items}))"
    totals = {
        "total_ratings": "count(*)",
        "num_users": f"any_value({n_users})",
        "num_items": f"any_value({n_items})",
        "sparsity": f"1 - count(*) / (any_value({n_users}) * any_value({n_items}))",
    }
    missing = {
        "null_ratings": "count(*) filter (userId is null or movieId is null or rating is null)",
        "invalid_ratings": "count(*) filter (rating < 0.5 or rating > 5.0)",
    }
    values = {
        "avg_rating": "case when bool_or(isnan(rating)) then cast('nan' as double) else avg(cast(rating as double)) end",
        # Without the filter the aggregate stops at a NaN, which the other branch covers.
        "std_rating": "case when bool_or(isnan(rating)) then cast('nan' as double)"
        " else stddev_samp(cast(rating as double)) filter (where not isnan(rating)) end",
        "min_rating": "min(cast(rating as double))",
        "max_rating": "max(cast(rating as double))",
    }
    return " union all ".join(
        (
            _long("table_counts", "select * from movies", movies="count(*)"),
            _long("table_counts", "select * from events", tags="count(*)"),
            _long("totals", f"select * from {ratings}", **totals),
            _long("rating_stats", f"select * from {ratings}", **values),
            _long("missing_ratings", f"select * from {ratings}", **missing),
            _long("user_activity_stats", users, **spread),
            _long("item_popularity_stats", items, **spread),
            _long("cold_users", users, **cold),
            _long("cold_items", items, **cold),
            _long("missing_genres", "select * from movies where genres is null or genres = '(no genres listed)'", missing_genres="count(*)"),
        )
    )


_RMSE_KEYS = f"""
    select 'rmse' as metric, segment, cast(null as int) as k, true as present
    from (select distinct case when n < 10 then 'cold' when n >= 50 then 'warm' end as segment
          from (select user_idx, count(*) as n from train group by user_idx) s
          where user_idx in (select user_idx from test where item_idx in (select item_idx from train)))
    where segment is not null"""

_HELD_OUT_KEYS = """
    select distinct m.metric, split as segment, cast(null as int) as k, true as present
    from indexed cross join (select unnest(['rmse', 'mae']) as metric) m where split <> 'train'"""

_AT_K_KEYS = "select m.metric, 'test' as segment, k, true as present from ks cross join (select unnest(['precision', 'recall']) as metric) m"

_QUERIES = {
    "csv_ratings_roundtrip": "select * from ratings",
    "csv_rejects": """
        with written as (
            select *, concat_ws(',', userId, movieId, rating) as head, concat_ws(',', userId, movieId, rating, timestamp) as whole
            from ratings),
        rejects as (
            select case when timestamp % 97 = 0 then 'x' || whole
                        when timestamp % 89 = 0 then whole || ',1'
                        when timestamp % 83 = 0 then head
                        when timestamp % 79 = 0 then concat_ws(',', userId, movieId, 'good', timestamp) end as line,
                   case when timestamp % 97 = 0 then 'userId is no int'
                        when timestamp % 89 = 0 then 'more than 4 fields'
                        when timestamp % 83 = 0 then 'fewer than 4 fields'
                        when timestamp % 79 = 0 then 'rating is no float' end as reason
            from written)
        select * from rejects where reason is not null
        union all select cast(count(*) as varchar), 'good' from rejects where reason is null""",
    "csv_movies_roundtrip": "select movieId, 'Say \"' || title || '\", twice' as title, genres from movies",
    "tags_count": "select 'tags' as name, count(*) as n from events",
    "split_roundtrip_counts": """
        select 'ratings_processed' as name, count(*) as n from indexed
        union all select 'movies', count(*) from movies
        union all select split, count(*) from indexed group by split""",
    "stats_json_roundtrip": _STATISTICS,
    "metrics_json_roundtrip": _SUITE_SAMPLED,
    "model_roundtrip": """
        select 'user' as side, count(distinct user_idx) as n, cast(0 as bigint) as differing from train
        union all select 'item', count(distinct item_idx), 0 from train""",
    "clean_ratings": "select * from clean_dirty",
    "clean_report": """
        select total, missing, total - missing - kept as out_of_range, kept, total - kept as removed
        from (select count(*) as total,
                     count(*) filter (userId is null or movieId is null or rating is null or isnan(rating)) as missing
              from dirty)
        cross join (select count(*) as kept from clean_dirty)""",
    "dq_null_ratings": """
        select count(*) filter (userId is null or movieId is null or rating is null) as null_ratings from dirty""",
    "dq_invalid_ratings": "select count(*) filter (rating < 0.5 or rating > 5.0) as invalid_ratings from dirty",
    "dq_missing_genres": """
        select count(*) filter (genres is null or genres = '(no genres listed)') as missing_genres from movies""",
    "active_users": "select userId, count(*) as n from clean group by userId having count(*) >= 30",
    "active_items": "select movieId, count(*) as n from clean group by movieId having count(*) >= 25",
    "filter_inactive": "select * from processed",
    "user_index": "select * from users",
    "item_index": "select * from items",
    "indexed_ratings": "select userId, movieId, rating, timestamp, user_idx, item_idx from indexed",
    "split_train": "select * from processed where timestamp % 100 < 80",
    "split_val": "select * from processed where timestamp % 100 >= 80 and timestamp % 100 < 90",
    "split_test": "select * from processed where timestamp % 100 >= 90",
    "split_by_hash": """
        select case when b < 80 then 'train' when b < 90 then 'validation' else 'test' end as split, count(*) as n,
               cast(sum(timestamp) as bigint) as sum_timestamp
        from (select timestamp, cast('0x' || substr(md5('42:' || userId || ':' || movieId || ':' || timestamp), 1, 8) as bigint) % 100 as b
              from clean) group by 1""",
    "filter_inactive_twice": """
        select p.* from processed p
        where userId in (select userId from processed group by userId having count(*) >= 30)
          and movieId in (select movieId from processed group by movieId having count(*) >= 25)""",
    "split_shares": """
        select split, count(*) as n, round(count(*) * 100 / (select count(*) from indexed), 6) as share_pct
        from indexed group by split""",
    "profile_sketches": """
        select count(*) as n_ratings, true as users_near, true as items_near, true as median_near, true as same_as_one_load
        from ratings""",
    "dataset_counts": """
        select 'ratings' as name, count(*) as n from ratings
        union all select 'users', count(distinct userId) from ratings
        union all select 'rated_items', count(distinct movieId) from ratings
        union all select 'movies', count(*) from movies
        union all select 'tags', count(*) from events""",
    "rating_distribution": "select rating, count(*) as n from ratings group by rating",
    "rating_stats": """
        select round(avg(r), 6) as avg_rating, round(stddev_samp(r), 6) as std_rating,
               round(min(r), 6) as min_rating, round(max(r), 6) as max_rating
        from (select cast(rating as double) as r from ratings)""",
    "matrix_sparsity": """
        select count(*) as total_ratings, count(distinct userId) as num_users, count(distinct movieId) as num_items,
               round(1 - count(*) / (count(distinct userId) * count(distinct movieId)), 6) as sparsity
        from ratings""",
    "user_activity": f"""
        select userId, n as num_ratings, round(a, 6) as avg_rating from ({_COUNTS_PER_USER.format('ratings')})""",
    "item_popularity": f"""
        select movieId, n as num_ratings, round(a, 6) as avg_rating from ({_COUNTS_PER_ITEM.format('ratings')})""",
    "user_activity_stats": _activity_stats(_COUNTS_PER_USER.format("ratings")),
    "item_popularity_stats": _activity_stats(_COUNTS_PER_ITEM.format("ratings")),
    "ratings_per_user_median": _median(_COUNTS_PER_USER.format("processed")),
    "ratings_per_item_median": _median(_COUNTS_PER_ITEM.format("processed")),
    "dataset_statistics": _STATISTICS,
    "cold_share": f"""
        select 'user' as side, count(*) filter (n < 25) as cold, count(*) as total,
               round(count(*) filter (n < 25) / count(*), 6) as share from ({_COUNTS_PER_USER.format('ratings')})
        union all
        select 'item', count(*) filter (n < 25), count(*), round(count(*) filter (n < 25) / count(*), 6)
        from ({_COUNTS_PER_ITEM.format('ratings')})""",
    "top_active_users": f"""
        select userId, n as num_ratings, round(a, 6) as avg_rating from ({_COUNTS_PER_USER.format('ratings')})
        order by n desc, userId limit 10""",
    "top_rated_movies": f"""
        select c.movieId, title, n as num_ratings, round(a, 6) as avg_rating
        from ({_COUNTS_PER_ITEM.format('ratings')}) c join titled m on c.movieId = m.movieId
        order by n desc, c.movieId limit 10""",
    "explore_summary": _explore("dirty"),
    "explore_summary_without_nan": _explore("ratings"),
    "explore_tables": f"""
        select 'rating_distribution' as report, cast(null as int) as id, cast(rating as double) as rating, n
        from (select rating, count(*) as n from ratings group by rating)
        union all
        select * from (select 'top_active_users', userId, round(a, 6), n
                       from ({_COUNTS_PER_USER.format('ratings')}) order by n desc, userId limit 10)
        union all
        select * from (select 'top_rated_movies', c.movieId, round(a, 6), n
                       from ({_COUNTS_PER_ITEM.format('ratings')}) c join movies m on c.movieId = m.movieId
                       order by n desc, c.movieId limit 10)""",
    "user_sample": f"select distinct user_idx from test where {_sampled('user_idx', _TENTH)}",
    "random_users": """
        select id from factors
        order by cast('0x' || substr(md5('42:' || cast(id as varchar)), 1, 8) as bigint), id limit 5""",
    "topn_from_factors": "select user_idx, item_idx, round(score, 6) as score, rank from recs",
    "topn_pruned": "select user_idx, item_idx, round(score, 6) as score, rank from recs",
    "topn_exclude_seen": """
        select * from (
            select user_idx, item_idx, round(score, 6) as score,
                   cast(row_number() over (partition by user_idx order by s.score desc, item_idx) as int) as rank
            from scores s
            where not exists (select 1 from train t where t.user_idx = s.user_idx and t.item_idx = s.item_idx))
        where rank <= 20""",
    "topn_bad_vectors": """
        select r.*, n_rejected from (
            select user_idx, item_idx, round(score, 6) as score,
                   cast(row_number() over (partition by user_idx order by s.score desc, item_idx) as int) as rank
            from scores s
            where user_idx % 7 <> 0 and user_idx % 11 <> 0 and user_idx % 13 <> 0
              and item_idx % 7 <> 0 and item_idx % 11 <> 0 and item_idx % 13 <> 0) r
        cross join (select 2 * count(*) filter (id % 7 = 0 or id % 11 = 0 or id % 13 = 0) as n_rejected from factors)
        where rank <= 20""",
    "topn_clamped": """
        select user_idx, item_idx, rank, round(least(5.0, greatest(0.5, 1 + 4 * score)), 6) as predicted_rating from recs""",
    "topn_stars": """
        select user_idx, item_idx, rank,
               repeat('⭐', cast(trunc(p) as int)) || repeat('☆', 5 - cast(trunc(p) as int)) as stars
        from (select *, least(5.0, greatest(0.5, 1 + 4 * score)) as p from recs)""",
    "topn_with_titles": """
        select user_idx, r.item_idx, rank, i.movieId, title
        from recs r left join items i on r.item_idx = i.item_idx left join titled m on i.movieId = m.movieId""",
    "batch_status": """
        select cast(c_custkey as int) as user_id,
               case when id is null then 'user_not_found' else 'success' end as status
        from customer left join factors on c_custkey = id""",
    "batch_recommend": """
        select cast(c_custkey as int) as user_id, case when f.id is null then 'user_not_found' else 'success' end as status,
               rank, r.item_idx,
               case when score is not null then round(least(5.0, greatest(0.5, score)), 6) end as predicted_rating, i.movieId, title
        from customer c left join factors f on c_custkey = f.id
        left join ranked r on r.user_idx = c_custkey and rank <= c_nationkey + 1
        left join items i on r.item_idx = i.item_idx left join titled m on i.movieId = m.movieId""",
    "error_metrics": """
        select split, round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) as rmse,
               round(avg(abs(prediction - rating)), 6) as mae, round(avg(prediction), 6) as avg_prediction,
               count(prediction) as num_predictions
        from predictions group by split""",
    "precision_recall_at_k": """
        select k, round(avg(p), 6) as precision, round(avg(r), 6) as recall from user_metrics group by k""",
    "precision_recall_nested": """
        select k, round(avg(p), 6) as precision, round(avg(r), 6) as recall from user_metrics group by k""",
    "precision_recall_sampled": f"""
        select k, round(avg(p), 6) as precision, round(avg(r), 6) as recall from user_metrics
        where {_sampled('user_idx', _HALF)} group by k""",
    "catalog_coverage": """
        select recommended_items, total_items, round(recommended_items / total_items, 6) as coverage
        from (select count(distinct item_idx) as recommended_items from recs)
        cross join (select count(*) as total_items from popularity)""",
    "popularity_bias": """
        select round(shown, 6) as avg_recommended_popularity, round(overall, 6) as avg_popularity,
               round(shown / overall, 6) as popularity_bias
        from (select avg(popularity) as shown from recs r join popularity p on r.item_idx = p.item_idx)
        cross join (select avg(popularity) as overall from popularity)""",
    "cold_warm_segments": """
        select t.userId, segment, n_train, count(*) as n_test
        from clean_split t join segments s on t.userId = s.userId
        where t.split = 'test' and segment is not null group by t.userId, segment, n_train""",
    "user_segments_with_mid": """
        select coalesce(segment, 'mid') as segment, count(*) as n from segments group by 1""",
    "cold_warm_rmse": "select segment, round(rmse, 6) as rmse, num_predictions from segment_rmse",
    "cold_warm_gap": """
        select round(c, 6) as cold_rmse, round(w, 6) as warm_rmse, round((c / w - 1) * 100, 6) as gap_pct
        from (select max(rmse) filter (segment = 'cold') as c, max(rmse) filter (segment = 'warm') as w from segment_rmse)""",
    "evaluation_suite": _SUITE,
    "metric_bars_by_segment": f"select segment, value as rmse from ({_SUITE_SAMPLED}) where metric = 'rmse'",
    "metric_bars_by_k": f"""
        select k, max(value) filter (metric = 'precision') as precision, max(value) filter (metric = 'recall') as recall
        from ({_SUITE}) where metric in ('precision', 'recall') group by k""",
    "factor_first_mean": "select round(avg(cast(features[1] as double)), 6) as first_factor_mean from factors",
    "als_factor_info": """
        select count(distinct user_idx) as num_user_factors, count(distinct item_idx) as num_item_factors,
               cast(4 as int) as rank from train""",
    "als_prediction_keys": """
        select user_idx, item_idx, timestamp, split from indexed
        where split <> 'train' and user_idx in (select user_idx from train) and item_idx in (select item_idx from train)""",
    "als_score_check": """
        select count(*) as n, true as as_transform, true as rmse_equal, true as mae_equal from indexed
        where split <> 'train' and user_idx in (select user_idx from train) and item_idx in (select item_idx from train)""",
    "als_topn_counts": """
        select user_idx, least(10, n_items) as n, least(10, n_items) as n_items, cast(least(10, n_items) as int) as last_rank
        from (select distinct user_idx from train) cross join (select count(*) as n_items from popularity)""",
    "clustered_roundtrip": "select userId, movieId, rating, timestamp, user_idx, item_idx, split from indexed",
    "prepare_job": "select userId, movieId, rating, timestamp, user_idx, item_idx, split from indexed",
    "prepare_reports": _long(
        "clean_report",
        "select * from dirty",
        total="count(*)",
        missing="count(*) filter (userId is null or movieId is null or rating is null or isnan(rating))",
        kept="any_value((select count(*) from clean_dirty))",
        out_of_range="count(*) filter (userId is not null and movieId is not null and rating is not null"
        " and not isnan(rating)) - any_value((select count(*) from clean_dirty))",
        removed="count(*) - any_value((select count(*) from clean_dirty))",
    )
    + " union all "
    + _long(
        "filter_report",
        "select * from clean_dirty",
        ratings_before="count(*)",
        users_before="count(distinct userId)",
        items_before="count(distinct movieId)",
        ratings_after="any_value((select count(*) from processed))",
        users_after="any_value((select count(distinct userId) from processed))",
        items_after="any_value((select count(distinct movieId) from processed))",
        removed="count(*) - any_value((select count(*) from processed))",
    )
    + """
        union all
        select 'split_shares', split, round(count(*) * 100 / (select count(*) from indexed), 6) from indexed group by split
        union all
        select 'user_index', cast(userId as varchar), cast(user_idx as double) from users
        union all
        select 'item_index', cast(movieId as varchar), cast(item_idx as double) from items""",
    "recommend_job": """
        with known as (select distinct user_idx from train), wanted as (
            select cast(c_custkey as bigint) as user_id, c_nationkey + 1 as asked from customer
            union all select 1099511627776, 5 union all select 0, 1099511627776),
        seen as (select user_idx, count(distinct item_idx) as n_seen from train group by user_idx)
        select user_id,
               case when asked > 100 then 'invalid_request' when k.user_idx is null then 'user_not_found' else 'success' end as status,
               cast(case when asked <= 100 and k.user_idx is not null
                         then least(asked, (select count(*) from popularity) - n_seen) else 0 end as bigint) as n_items,
               true as none_seen
        from wanted left join known k on k.user_idx = user_id left join seen s on s.user_idx = user_id""",
    "train_job": f"""
        select metric, 'validation' as segment, cast(null as int) as k, true as present,
               cast(case when metric = 'num_predictions' then n end as double) as value
        from (select unnest(['rmse', 'mae', 'avg_prediction', 'num_predictions']) as metric)
        cross join (select count(*) as n from indexed where split = 'validation'
                    and user_idx in (select user_idx from train) and item_idx in (select item_idx from train))
        union all select *, null from ({_AT_K_KEYS})
        union all select 'coverage', 'train', 100, count(*) > 0, null from train""",
    "evaluate_job": f"""
        {_HELD_OUT_KEYS}
        union all {_AT_K_KEYS}
        union all select 'coverage', 'train', 100, count(*) > 0 from train
        union all select 'popularity_bias', 'test', 20, count(*) > 0 from test
        union all {_RMSE_KEYS}""",
}


def _with_ctes(name: str, sql: str) -> str:
    ctes = {**_ALL, **_pipeline("clean_dirty")} if name in ("prepare_job", "prepare_reports") else _ALL
    body = ",\n".join(f"{cte} as ({text})" for cte, text in ctes.items())
    # A query may bring tables of its own.
    own = sql.lstrip()
    return f"with {body},\n{own[5:]}" if own.startswith("with ") else f"with {body}\n{sql}"


def oracle_sql() -> dict[str, str]:
    return {name: _with_ctes(name, sql) for name, sql in _QUERIES.items()}
