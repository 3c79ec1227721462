"""``spark-submit run_job.py JOB --input ... --output ...``"""

from tallywing.jobs import run

if __name__ == "__main__":
    run()
