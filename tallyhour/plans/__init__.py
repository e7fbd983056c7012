from tallyhour.plans.jobs import (Options, JobResult, run_events, run_ssp, run_syndication,  # noqa: F401
                                  run_demand_partner, run_gam, consolidate, run_all)
