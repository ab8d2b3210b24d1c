from crashlake.plans.jobs import main

main()
