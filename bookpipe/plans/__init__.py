"""The composed jobs: cleaning, daily rankings, the nightly batch."""
