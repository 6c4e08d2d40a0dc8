"""Silver and gold as views for SQL users."""

from rosterlake.plans import gold, silver


def register_views(employees, projects, rates, timesheets, prune_key=None):
    """Create or replace the six temporary views of the session.

    prune_key: "work_date" for a fact made by the load lets filters on the day reach its partitions.
    """
    views = {
        "silver_employees": silver.silver_employees(employees),
        "silver_projects": silver.silver_projects(projects),
        "silver_timesheets": silver.silver_timesheets(timesheets, prune_key=prune_key),
        "silver_exchange_rates": silver.silver_exchange_rates(rates),
    }
    views["gold_employees"] = gold.gold_employees(
        views["silver_employees"], views["silver_exchange_rates"]
    )
    views["gold_timesheets_enriched"] = gold.gold_timesheets_enriched(
        views["silver_timesheets"], views["silver_employees"],
        views["silver_projects"], views["silver_exchange_rates"],
    )
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return views
